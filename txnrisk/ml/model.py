"""Fitted models of the batched fits: a scaling and a predictor, scored inside the caller's plan.

A model is saved as two tables, its relation (weights or tree nodes) and one line of settings."""

from __future__ import annotations

import json
import os

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import write_scratch
from .frame import Scaling
from .logit import LogitPredictor
from .trees import TreePredictor, TreeTable, ensemble

PROB = "prob_fraud"
#: bytes of a tree model's arrays sent with one scoring function (a tree is never cut); more trees go in
#: several functions, whose sums are added
BLOCK_BYTES = 64 << 20
NODE_BYTES = 48

KINDS = {p.kind: p for p in (LogitPredictor, TreePredictor)}


class FittedModel:
    def __init__(self, scaling: Scaling, predictor, group: int = 0):
        self.scaling, self.predictor, self.group = scaling, predictor, group

    def probability(self, spark: SparkSession) -> Column:
        """P(class 1) over the raw input columns.  Trees that stay a table are collected for it; see :meth:`transform`."""
        p = self.predictor
        if isinstance(p, TreeTable):
            p = TreePredictor(p.nodes.toArrow())
        if p.kind == "logit" and len(p.weights) == 1:              # stays in the JVM, as generated code
            *w, z = p.weights[0].tolist()
            z = F.lit(z)
            for v, x in zip(w, self._inputs()):
                z = z + F.lit(v) * x
            return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        if p.kind == "logit":
            return _function(spark, p.predict)(*self._inputs())
        parts = blocks(p)
        total = None
        for part in parts:
            one = _function(spark, part.sums)(*self._inputs())
            total = one if total is None else total + one
        if p.rate is None:
            return total / F.lit(float(len(p.roots)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(p.start) + F.lit(float(p.rate)) * total)))

    def _inputs(self) -> list[Column]:
        s = self.scaling
        return [s._z(F.col(c).cast("double"), F.lit(float(m)), F.lit(float(1 / d if d else 0.0)))
                for c, m, d in zip(s.cols, s.mean[self.group], s.std[self.group])]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prob_fraud``; its other columns stay as they are."""
        if not isinstance(self.predictor, TreeTable) or df.isStreaming:        # a stream's plan takes the trees along
            return df.withColumn(PROB, self.probability(df.sparkSession))
        keep = [c for c in df.columns if c != PROB]
        out = [*df.columns, *([] if PROB in df.columns else [PROB])]
        # written once: a row's number must not change between its two uses
        rows = write_scratch(df.select(*keep, F.array(*self._inputs()).alias("__x"), F.monotonically_increasing_id().alias("__row")), "tree-rows")
        scores = self.predictor.scores(rows.select("__x", "__row"))
        scores = scores.select(F.col("row").alias("__row"), F.col("share").alias("__share"))
        return rows.join(scores, "__row").withColumnRenamed("__share", PROB).select(*out)

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        table = self.predictor.table()
        (table if isinstance(table, DataFrame) else spark.createDataFrame(table.to_pandas())).write.mode("overwrite").parquet(os.path.join(path, "relation"))
        line = json.dumps({"kind": self.predictor.kind, "group": self.group, "scaling": self.scaling.state(), "settings": self.predictor.state()})
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(os.path.join(path, "settings"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FittedModel":
        state = json.loads(spark.read.text(os.path.join(path, "settings")).first()[0])
        table = spark.read.parquet(os.path.join(path, "relation"))
        if state["kind"] == TreePredictor.kind:
            predictor = ensemble(table, state["settings"]["rate"])
        else:
            predictor = KINDS[state["kind"]].of(table.toArrow(), state["settings"])
        return cls(Scaling.of(state["scaling"]), predictor, state["group"])


def blocks(p: TreePredictor, limit: int = BLOCK_BYTES) -> list[TreePredictor]:
    """The trees in blocks of at most ``limit`` bytes, one tree at least."""
    if len(p.value) * NODE_BYTES <= limit:
        return [p]
    t = p.nodes.to_pandas()
    t = t[t["member"] >= 0]
    sizes = t.groupby("member").size().sort_index()
    block = (sizes.cumsum() - 1) * NODE_BYTES // limit
    return [TreePredictor.of(pa.Table.from_pandas(t[t["member"].isin(members.index)], preserve_index=False), {"rate": p.rate})
            for _, members in sizes.groupby(block)]


def _function(spark: SparkSession, score):
    sent = spark.sparkContext.broadcast(score)

    @F.pandas_udf("double")
    def run(*columns: pd.Series) -> pd.Series:
        return pd.Series(sent.value(np.column_stack([c.to_numpy(dtype=float) for c in columns])))

    return run

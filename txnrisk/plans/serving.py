"""Batch scoring of requests against frozen snapshots and a fitted model."""

from __future__ import annotations

import hashlib
import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from .. import schema as S
from ..ml.model import FittedModel
from ..ml.pipeline import PROB
from ..ml.tuning import predict
from ..operators.calendar import add_calendar_flags
from ..operators.snapshot import enrich

SNAPSHOTS = (("customer_snapshot", S.CUSTOMER_ID), ("terminal_snapshot", S.TERMINAL_ID))


def enrich_requests(requests: DataFrame, customer_snap: DataFrame, terminal_snap: DataFrame) -> DataFrame:
    """Calendar flags + the last-known customer and terminal features."""
    r = add_calendar_flags(requests)
    return enrich(enrich(r, customer_snap, S.CUSTOMER_ID), terminal_snap, S.TERMINAL_ID)


def score_requests(requests: DataFrame, customer_snap: DataFrame, terminal_snap: DataFrame,
                   model) -> DataFrame:
    """One reply row (TRANSACTION_ID, prob_fraud) per request; unknown keys
    are imputed by the model's own mean imputer.  ``model`` is any fitted
    configuration: a fitted model or a pipeline."""
    return predict(model, enrich_requests(requests, customer_snap, terminal_snap)).select(S.TX_ID, PROB)


def _table_name(path: str, name: str) -> str:
    return f"txnrisk_{name}_{hashlib.sha1(path.encode()).hexdigest()[:12]}"


def save_snapshots(path: str, customer_snap: DataFrame, terminal_snap: DataFrame, buckets: int | None = None) -> None:
    """Both snapshots as Parquet under one folder.

    With ``buckets`` they are written as tables bucketed and sorted by their key: a
    join with them then shuffles only the request side, which matters for
    streaming, where every micro-batch would otherwise shuffle the whole snapshot
    again.  The bucket count is kept beside them, so another session can
    re-register the tables."""
    spark = customer_snap.sparkSession
    for (name, key), df in zip(SNAPSHOTS, (customer_snap, terminal_snap)):
        p = os.path.join(path, name)
        if buckets:
            (df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
               .option("path", p).saveAsTable(_table_name(path, name)))
        else:
            df.write.mode("overwrite").parquet(p)
    spark.createDataFrame([(int(buckets or 0),)], "buckets int").write.mode("overwrite").json(os.path.join(path, "buckets"))


def load_snapshots(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    buckets = spark.read.json(os.path.join(path, "buckets")).first()["buckets"]
    snaps = []
    for name, key in SNAPSHOTS:
        p = os.path.join(path, name)
        if buckets:
            tbl = _table_name(path, name)
            if not spark.catalog.tableExists(tbl):
                cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(p).schema)
                spark.sql(f"CREATE TABLE {tbl} ({cols}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
                          f"INTO {buckets} BUCKETS LOCATION '{p}'")
            snaps.append(spark.table(tbl))
        else:
            snaps.append(spark.read.parquet(p))
    return tuple(snaps)


def drop_tables(spark: SparkSession, path: str) -> None:
    """Forget the tables that :func:`save_snapshots` registered; the files stay."""
    for name, _ in SNAPSHOTS:
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(path, name)}")


def save_artifacts(path: str, model, customer_snap: DataFrame, terminal_snap: DataFrame,
                   buckets: int | None = None) -> None:
    """A fitted model (its relation and settings, or an ML pipeline) and the snapshots, under one folder."""
    spark = customer_snap.sparkSession
    fitted = isinstance(model, FittedModel)
    if fitted:
        model.save(os.path.join(path, "model"))
    else:
        model.write().overwrite().save(os.path.join(path, "model"))
    save_snapshots(path, customer_snap, terminal_snap, buckets)
    spark.createDataFrame([(fitted,)], "fitted boolean").write.mode("overwrite").json(os.path.join(path, "manifest"))


def load_artifacts(spark: SparkSession, path: str):
    """(model, customer snapshot, terminal snapshot) saved by :func:`save_artifacts`."""
    about = spark.read.json(os.path.join(path, "manifest")).first()
    load = (lambda p: FittedModel.load(spark, p)) if about["fitted"] else PipelineModel.load
    return (load(os.path.join(path, "model")), *load_snapshots(spark, path))

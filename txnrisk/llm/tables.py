"""Shared helpers of the text operators: input tables, written intermediate tables, global
running totals and connected components.  Everything that outlives one job is a Parquet table
under the folder that ``spark.checkpoint.dir`` names, so a lost executor costs a reread only."""

from __future__ import annotations

import gc
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")


def save(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage ends here."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete a table made by :func:`save` that no later step reads, and let Spark's cleaner drop the
    shuffle files of the steps behind it: it waits for a garbage collection of the driver's JVM."""
    spark = df.sparkSession
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        if "/llm-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def ordered_totals(df: DataFrame, keys: list[Column | str], weights: list[str], name: str) -> DataFrame:
    """Add ``__row_no`` (0-based position in the order of ``keys``) and, for each weight column,
    ``__before_<weight>`` (sum over the earlier rows), with no single-partition sort.

    Rows are range-partitioned and sorted, each task numbers its own rows, and the totals of the
    tasks (one small row each) become offsets.  ``keys`` must order equal rows alike in any run;
    rows equal in all keys are interchangeable.  Nulls sort first.  An empty input stays empty."""
    spark = df.sparkSession
    names = [f"__before_{w}" for w in weights]
    ranged = (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
              .withColumn("__part", F.spark_partition_id()))
    schema = T.StructType(ranged.schema.fields + [T.StructField(n, T.LongType()) for n in ["__row_no", *names]])

    def number(batches):
        rows, sums = 0, [0] * len(weights)
        for b in batches:
            cols = list(b.columns) + [pa.array(np.arange(rows, rows + b.num_rows, dtype=np.int64))]
            rows += b.num_rows
            for i, w in enumerate(weights):
                v = b.column(b.schema.get_field_index(w)).to_numpy(zero_copy_only=False).astype(np.int64)
                ends = sums[i] + np.cumsum(v)
                cols.append(pa.array(ends - v))
                sums[i] = int(ends[-1]) if len(ends) else sums[i]
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in schema.fields])

    local = save(ranged.mapInArrow(number, schema), name)
    per_part = (local.groupBy("__part").agg(F.count(F.lit(1)).alias("__row_no"),
                                           *[F.sum(w).alias(n) for w, n in zip(weights, names)])
                .orderBy("__part").collect())          # one row per task
    offsets, acc = [], [0] * (1 + len(names))
    for r in per_part:
        offsets.append((r["__part"], *acc))
        acc = [a + (r[n] or 0) for a, n in zip(acc, ["__row_no", *names])]
    small = spark.createDataFrame(offsets, T.StructType(
        [T.StructField("__part", T.IntegerType())]
        + [T.StructField(f"__off_{n}", T.LongType()) for n in ["__row_no", *names]]))
    out = local.join(F.broadcast(small), "__part")     # as many rows as the sort had tasks
    return out.select(*df.columns, *[(F.col(n) + F.col(f"__off_{n}")).alias(n) for n in ["__row_no", *names]])


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, component) for every node of the undirected ``links`` (a, b); the component is its
    smallest node.  Minimum-label propagation with pointer jumping: each round is three equi-joins
    with pre-aggregated minima, and its labels are written, so the lineage stays one round long."""
    edges = save(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                 .where("a <> b").distinct(), f"{name}-edges")
    labels = save(edges.groupBy(F.col("a").alias("node"))
                  .agg(F.least(F.min("b"), F.first("a")).alias("component")), f"{name}-labels")
    while True:
        near = (edges.join(labels.select(F.col("node").alias("b"), "component"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        step = labels.join(near, "node", "left").select(
            "node", "component", F.least("component", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("component").alias("jumped"))
        new = save(step.join(jump, "low", "left").select(
            "node", F.col("component").alias("old"),
            F.least("low", F.coalesce("jumped", "low")).alias("component")), f"{name}-labels")
        changed = new.where("old <> component").limit(1).count()
        release(labels)
        labels = new.select("node", "component")
        if not changed:
            release(edges)
            return labels


def fixed_bitmap(df: DataFrame, hash64: Column, bits: int = 22) -> np.ndarray:
    """A bitmap of 2**bits flags (packed), set at the first ``bits`` bits of a 64-bit hash of each row.
    Its size does not depend on the rows, so it may travel to every task; it only thins out, and
    who uses it joins exactly afterwards."""
    spot = F.shiftrightunsigned(hash64, 64 - bits)
    rows = (df.select(F.shiftright(spot, 6).cast("int").alias("w"), spot.bitwiseAND(F.lit(63)).cast("int").alias("k"))
            .groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, k)")).alias("m")).collect())
    out = np.zeros(1 << (bits - 6), np.int64)
    for r in rows:
        out[r["w"]] = r["m"]
    return out.view(np.uint8)


def flags(bitmap: np.ndarray) -> np.ndarray:
    return np.unpackbits(bitmap, bitorder="little").astype(bool)


def in_bitmap(spark: SparkSession, bitmap: np.ndarray, hash64: Column) -> Column:
    """Whether a 64-bit hash falls on a set flag of a :func:`fixed_bitmap`."""
    sent, shift = spark.sparkContext.broadcast(bitmap), np.uint64(62 - len(bitmap).bit_length())

    @F.pandas_udf("boolean")
    def hit(h: pd.Series) -> pd.Series:
        spot = h.to_numpy().view(np.uint64) >> shift
        return pd.Series((sent.value[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1)

    return hit(hash64)

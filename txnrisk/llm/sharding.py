"""Hilbert-curve ordering: metadata dimensions are quantised, rows are sorted by their index on a
Hilbert curve through the cells, and runs of that order become shards of equal row counts.

Neighbours on the curve lie in neighbouring cells, so each shard spans a small box of every
dimension and a reader can skip shards by their minima and maxima (:func:`manifest`)."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import ordered_totals, read_table, save

SHARDS = 40
BITS = 6


def hilbert_index(cells: list[np.ndarray], bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points (one array per dimension, values below
    2**bits), by the transpose method of Skilling (2004), vectorised over the points."""
    axes = [np.asarray(c, np.int64).copy() for c in cells]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(len(axes)):
            hit = (axes[i] & q) != 0
            swap = np.where(hit, 0, (axes[0] ^ axes[i]) & low)
            axes[0] ^= np.where(hit, low, swap)
            axes[i] ^= swap
        q >>= 1
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    flip = np.zeros_like(axes[0])
    q = top
    while q > 1:
        flip ^= np.where((axes[-1] & q) != 0, q - 1, 0)
        q >>= 1
    out = np.zeros_like(axes[0])
    for bit in range(bits - 1, -1, -1):
        for a in axes:
            out = (out << 1) | (((a ^ flip) >> bit) & 1)
    return out


def quantise(df: DataFrame, dim: str, cell: str, bits: int) -> DataFrame:
    """Add ``cell``: the share of rows with a smaller value of ``dim``, in 2**bits steps (an
    equalised histogram).  It works for text and numbers alike; equal values share a cell and a
    null is in the lowest.  Only the distinct values are ordered, after a pre-aggregated count;
    the smallest value of each cell (2**bits at most) then places every row, without a join."""
    counts = df.groupBy(F.col(dim).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    ranked = ordered_totals(counts, ["__v"], ["__n"], "cells")
    total = ranked.agg(F.max(F.col("__before___n") + F.col("__n"))).first()[0] or 1
    place = F.floor(F.col("__before___n") * (1 << bits) / F.lit(total)).cast("int")
    lows = sorted((r[0], r[1]) for r in ranked.where("__v is not null").groupBy(place.alias("__c")).agg(F.min("__v")).collect())
    if not lows:
        return df.withColumn(cell, F.lit(0))
    reached = F.size(F.filter(F.array(*[F.lit(v) for _, v in lows]), lambda v: v <= F.col(dim)))
    return df.withColumn(cell, F.when(F.col(dim).isNull(), 0).otherwise(
        F.coalesce(F.get(F.array(*[F.lit(c) for c, _ in lows]), reached - 1), F.lit(0))))


def hilbert_order(df: DataFrame, dims: dict[str, Column], ties: list[Column | str], bits: int = BITS) -> DataFrame:
    """``df`` with ``hilbert`` (long) and ``position`` (0-based place in curve order, ties by
    ``ties`` and then by all values of the row that can be ordered).  Columns of ``df`` with those
    names are replaced.  Nulls form the lowest cell of their dimension; repeated rows take
    consecutive places; an empty table gives an empty result."""
    df = df.drop("hilbert", "position")
    work = df.withColumns({f"__d{i}": c for i, c in enumerate(dims.values())})
    names = [f"__c{i}" for i in range(len(dims))]
    for i, name in enumerate(names):
        work = quantise(work, f"__d{i}", name, bits)

    @F.pandas_udf("long")
    def curve(points: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index([points[c].to_numpy() for c in points.columns], bits))

    work = work.withColumn("__h", curve(F.struct(*names))).drop(*names, *[f"__d{i}" for i in range(len(dims))])
    out = ordered_totals(work, ["__h", *ties], [], "hilbert")
    return out.select(*df.columns, F.col("__h").alias("hilbert"), F.col("__row_no").alias("position"))


def cut_runs(ordered: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Cut the curve order into ``shards`` runs whose row counts differ by one at most: ``shard``
    (int) and ``slot`` (long, gapless from 0 inside the shard).  Other columns stay; an empty table stays empty."""
    total = ordered.count()
    pos = F.col("position")
    shard = F.expr(f"cast(cast(position as decimal(38,0)) * {shards} div {max(total, 1)} as long)")
    first = F.expr(f"(__s * {total} + {shards - 1}) div {shards}")
    return (ordered.withColumn("__s", shard).withColumn("slot", pos - first)
            .withColumn("shard", F.col("__s").cast("int")).drop("__s"))


def manifest(sharded: DataFrame, dims: list[str]) -> DataFrame:
    """Rows and the smallest and largest value of each dimension by shard, for skipping shards; nulls do not
    count, and an empty table has no shards."""
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"),
                                        *[f(d).alias(f"{n}_{d}") for d in dims for n, f in (("min", F.min), ("max", F.max))])


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order, with all their columns; an empty table gives an empty folder."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def document_dims(df: DataFrame) -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "bytes": F.octet_length(F.coalesce("text", F.lit("")))}


def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of equal row counts along the curve over source, language and size."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = save(read_table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", F.octet_length(text).cast("long").alias("bytes"),
        F.crc32(text).alias("text_crc32")), "shard-input")
    ordered = hilbert_order(narrow, {d: F.col(d) for d in ("source", "lang", "bytes")}, ["doc_id", "text_crc32"])
    return cut_runs(ordered).select(
        "doc_id", (F.col("bytes") + 16).alias("size"), "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "hilbert")

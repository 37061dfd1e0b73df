"""Hot keys: keys with too many rows for one task, and time slices for them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..session import write_scratch

# A key's running totals are one task's work, in proportion to its rows; beyond so
# many a key takes the event form (split over tasks).  Both give the same rows.
HOT_KEY_ROWS = 250_000
# Rows per time slice of the largest hot key, and slices per key at most.
ROWS_PER_BUCKET = 50_000
MAX_EDGES = 512
EDGES = "__edges"

FIND = object()   # "look for hot keys yourself"


def hot_keys(df: DataFrame, key: str, time_us: str, hot_rows: int = HOT_KEY_ROWS,
             rows_per_bucket: int | None = None) -> DataFrame | None:
    """(key, __edges) of the keys with more than ``hot_rows`` rows, or None.

    The counts are pre-aggregated and stay in a written table however many keys
    are hot; only the largest count reaches the driver.  The edges are quantiles
    of the key's own times, so a burst is cut as finely as a quiet stretch."""
    counts = write_scratch(df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
                           .where(F.col("__n") > hot_rows).select(key, "__n"), "hot-counts")
    top = counts.agg(F.max("__n")).first()[0]
    if top is None:
        return None
    parts = min(MAX_EDGES, math.ceil(top / (rows_per_bucket or ROWS_PER_BUCKET)))
    if parts < 2:
        return counts.select(key, F.array().cast("array<bigint>").alias(EDGES))
    probs = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    edges = (df.select(key, time_us).join(counts.select(key), key).groupBy(key)
             .agg(F.array_distinct(F.percentile_approx(time_us, probs, 10_000)).alias(EDGES)))
    return write_scratch(edges.select(key, F.coalesce(EDGES, F.array().cast("array<bigint>")).alias(EDGES)), "hot-edges")


def time_slice(event_us: Column) -> Column:
    """Number of the key's edges at or before the time: a monotone slice of its time line."""
    return F.size(F.filter(F.col(EDGES), lambda e: e <= event_us)).cast("bigint")

"""Running sums that do not put a whole group into one task.

A running sum over a group ordered by some column is split into ordered
buckets (a monotone coarsening of the order, e.g. the day of a timestamp or
the leading digits of a hash).  Each bucket is summed by a window partitioned
by (group, bucket); the sums of all earlier buckets come from a small
per-(group, bucket) aggregate and its own prefix.  A hot group is then spread
over as many tasks as it has buckets, and every window runs in O(n).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET = "__bucket"


def bucketed_running_sum(df: DataFrame, group_cols: list[str], bucket: Column,
                         order: list, measures: dict[str, Column], peers: bool = True) -> DataFrame:
    """Add one running-sum column per ``measures`` entry.

    ``order`` must refine ``bucket`` (rows of a later bucket sort later).  With
    ``peers=True`` the frame is RANGE (rows with an equal single order value
    all see each other); otherwise ROWS (``order`` should then be unique).
    Null group values form a group, and a null bucket comes first.
    """
    tmp = {n: f"__m_{i}" for i, n in enumerate(measures)}
    d = df.select("*", bucket.alias(BUCKET), *[m.alias(tmp[n]) for n, m in measures.items()])

    w_in = Window.partitionBy(*group_cols, BUCKET).orderBy(*order)
    w_run = (w_in.rangeBetween(Window.unboundedPreceding, Window.currentRow) if peers
             else w_in.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    w_all = w_in.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    within = d.select("*",
                      *[F.sum(tmp[n]).over(w_run).alias(f"{tmp[n]}_in") for n in measures],
                      *[F.sum(tmp[n]).over(w_all).alias(f"{tmp[n]}_tot") for n in measures])

    # Bucket totals are read off the window output: it is already hash
    # partitioned by (group, bucket), so this aggregate adds no exchange and
    # both branches reuse one shuffle of the input.
    tot = within.groupBy(*group_cols, BUCKET).agg(
        *[F.max(f"{tmp[n]}_tot").alias(tmp[n]) for n in measures])
    w_off = Window.partitionBy(*group_cols).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*group_cols, BUCKET,
                     *[F.sum(tmp[n]).over(w_off).alias(f"{tmp[n]}_off") for n in measures])

    # null-safe: a null group value or bucket (it sorts first) keeps its rows
    by = [*group_cols, BUCKET]
    off = off.select(*[F.col(c).alias(f"__by_{i}") for i, c in enumerate(by)], *[f"{tmp[n]}_off" for n in measures])
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & within[c].eqNullSafe(off[f"__by_{i}"])
    joined = within.join(off, same, "inner")
    out_cols = [c for c in df.columns]
    return joined.select(
        *out_cols,
        *[(F.col(f"{tmp[n]}_in") + F.coalesce(F.col(f"{tmp[n]}_off"), F.lit(0))).alias(n)
          for n in measures])

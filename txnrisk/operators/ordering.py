"""Dense ids in a global order (W6, O1) without a single-partition sort.

Rows are range-partitioned on the whole order by sampled bounds, so that each task
sorts about the same number of rows however they cluster; a task numbers its own
rows, and the totals of the tasks before it (one small row each) become its offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schema as S
from ..session import write_scratch

#: low bits of ``monotonically_increasing_id``: the row's place within its partition
_PLACE_BITS = 33


def numbered(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """``df`` with its 0-based position in ascending ``order`` (nulls first).  Rows equal
    in all of ``order`` are numbered in any way; an empty input stays empty."""
    at = "__at"
    local = write_scratch(df.repartitionByRange(*order).sortWithinPartitions(*order)
                          .withColumn(at, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(at, _PLACE_BITS)
    totals = local.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()   # one row per task
    offsets, acc = [], 0
    for r in totals:
        offsets.append((r["p"], acc))
        acc += r["n"]
    small = df.sparkSession.createDataFrame(offsets, "__p bigint, __offset bigint")
    place = F.col(at).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return local.join(F.broadcast(small), part == F.col("__p")).select(*df.columns, (F.col("__offset") + place).alias(out))


def chronological_id(tx: DataFrame, out: str = "CHRONO_ID",
                     order=(S.TX_US, S.CUSTOMER_ID, S.TERMINAL_ID, S.TX_ID)) -> DataFrame:
    """0..n-1 in (time, customer, terminal, id) order."""
    return numbered(tx, list(order), out)

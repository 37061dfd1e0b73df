"""Trailing windows on a skewed input: one customer owns a third of all rows.

Compares Spark's native RANGE frames (the whole hot customer in one task,
re-aggregating its 30-day frame for every row) with the ``auto`` strategy
(hot key split into time buckets, running sums of enter/leave events).
Usage: python tools/skew_bench.py [rows] [frame_timeout_sec]
"""

from __future__ import annotations

import os
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from txnrisk import schema as S  # noqa: E402
from txnrisk.functions import time as tf  # noqa: E402
from txnrisk.operators.rolling import customer_spending_windows  # noqa: E402
from txnrisk.session import build_session  # noqa: E402


def skewed(spark, n):
    days = 30
    r = spark.range(n)
    cust = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.pmod(F.xxhash64("id"), F.lit(100_000)) + 2)
    secs = F.pmod(F.xxhash64(F.col("id"), F.lit(7)), F.lit(days * 86400))
    ts = F.timestamp_add("SECOND", secs, F.lit("2024-01-01").cast("timestamp_ntz"))
    df = r.select(F.col("id").alias(S.TX_ID), ts.alias(S.TX_DATETIME), cust.cast("bigint").alias(S.CUSTOMER_ID),
                  (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(50_000)) / 100).cast("decimal(18,2)").alias(S.TX_AMOUNT))
    return df.withColumn(S.TX_US, tf.epoch_us(S.TX_DATETIME))


def run(df, **kw):
    t = time.time()
    customer_spending_windows(df, **kw).write.format("noop").mode("overwrite").save()
    return round(time.time() - t, 1)


def main():
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 600_000
    limit = int(sys.argv[2]) if len(sys.argv) > 2 else 120
    spark = build_session("local[8]", 8)
    df = skewed(spark, n)
    print("auto (hot key > 100k rows):", run(df, strategy="auto", hot_rows=100_000), "s")
    done = {}

    def frame():
        done["t"] = run(df, strategy="frame")

    th = threading.Thread(target=frame, daemon=True)
    spark.sparkContext.setJobGroup("frame", "frame", interruptOnCancel=True)
    th.start()
    th.join(limit)
    if "t" in done:
        print("frame:", done["t"], "s")
    else:
        spark.sparkContext.cancelJobGroup("frame")
        print(f"frame: not finished after {limit} s (cancelled)")


if __name__ == "__main__":
    main()

"""A key holding a third of all rows goes through the split (bucketed) path
and still gives exactly the native-frame numbers."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from txnrisk import schema as S
from txnrisk.functions import time as tf
from txnrisk.operators import hotkeys
from txnrisk.operators.rolling import customer_spending_windows, delayed_risk_windows


def _skewed(spark, n=3000):
    rnd = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        cust = 1 if i % 3 == 0 else rnd.randint(2, 60)          # customer 1: a third of all rows
        term = 7 if i % 3 == 1 else rnd.randint(1, 40)          # terminal 7: another third
        t = t0 + dt.timedelta(seconds=rnd.randint(0, 40 * 86400))
        rows.append((i, t, cust, term, Decimal(rnd.randint(1, 50000)) / 100, 1 if rnd.random() < 0.1 else 0))
    df = spark.createDataFrame(rows, "TRANSACTION_ID bigint, TX_DATETIME timestamp_ntz, CUSTOMER_ID bigint, "
                                     "TERMINAL_ID bigint, TX_AMOUNT decimal(18,2), TX_FRAUD bigint")
    return df.withColumn(S.TX_US, tf.epoch_us(S.TX_DATETIME))


def test_hot_keys_are_cut_at_their_own_quantiles(spark):
    df = _skewed(spark)
    hot = hotkeys.hot_keys(df, S.CUSTOMER_ID, S.TX_US, hot_rows=500, rows_per_bucket=50).collect()
    assert [r[S.CUSTOMER_ID] for r in hot] == [1]
    edges = hot[0][hotkeys.EDGES]
    assert edges == sorted(edges) and 15 <= len(edges) <= 20
    times = sorted(r[0] for r in df.where(f"{S.CUSTOMER_ID} = 1").select(S.TX_US).collect())
    sizes = [sum(a <= t < b for t in times) for a, b in zip(edges, edges[1:])]
    assert max(sizes) <= 2 * 50
    assert hotkeys.hot_keys(df, S.CUSTOMER_ID, S.TX_US, hot_rows=10_000) is None


def test_skewed_customer_windows_match_frames(spark, monkeypatch):
    monkeypatch.setattr(hotkeys, "ROWS_PER_BUCKET", 5)
    df = _skewed(spark)
    ref = customer_spending_windows(df, strategy="frame")
    got = customer_spending_windows(df, strategy="auto", hot_rows=500)
    assert got.count() == ref.count()
    assert got.exceptAll(ref).count() == 0


def test_skewed_terminal_windows_match_frames(spark):
    df = _skewed(spark)
    ref = delayed_risk_windows(df, strategy="frame")
    got = delayed_risk_windows(df, strategy="auto", hot_rows=500, bucket_us=S.DAY_US // 4)
    assert got.exceptAll(ref).count() == 0 and got.count() == ref.count()


def test_many_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(hotkeys, "ROWS_PER_BUCKET", 7)
    df = _skewed(spark, 1200)
    ref = delayed_risk_windows(df, strategy="frame")
    got = delayed_risk_windows(df, strategy="auto", hot_rows=10)
    assert got.exceptAll(ref).count() == 0 and got.count() == ref.count()


def test_null_times_and_amounts_agree_in_all_strategies(spark, monkeypatch):
    monkeypatch.setattr(hotkeys, "ROWS_PER_BUCKET", 3)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, None if i % 5 == 0 else t0 + dt.timedelta(hours=i), i % 2, i % 3, None if i % 2 else Decimal(i), 0 if i % 4 else None)
            for i in range(60)]
    df = spark.createDataFrame(rows, "TRANSACTION_ID bigint, TX_DATETIME timestamp_ntz, CUSTOMER_ID bigint, "
                                     "TERMINAL_ID bigint, TX_AMOUNT decimal(18,2), TX_FRAUD bigint")
    df = df.withColumn(S.TX_US, tf.epoch_us(S.TX_DATETIME))
    for fn in (customer_spending_windows, lambda d, **k: delayed_risk_windows(d, 1, **k)):
        ref = fn(df, strategy="frame")
        assert ref.count() == 60
        for kw in (dict(strategy="events"), dict(strategy="auto", hot_rows=2), dict(strategy="auto", hot_rows=25)):
            got = fn(df, **kw)
            assert got.count() == 60 and got.exceptAll(ref).count() == 0
    none = customer_spending_windows(df.where("CUSTOMER_ID = 1"), strategy="events")
    assert none.where("CUSTOMER_ID_AVG_AMOUNT_1DAY_WINDOW is not null").count() == 0 and none.count() == 30


def test_chronological_id_keeps_rows_without_time(spark):
    from txnrisk.operators.ordering import chronological_id
    rows = [(1, None), (2, t0 := dt.datetime(2024, 1, 1)), (3, None), (4, t0 + dt.timedelta(days=2))]
    df = spark.createDataFrame([(i, t, 1, 1) for i, t in rows], "TRANSACTION_ID bigint, TX_DATETIME timestamp_ntz, CUSTOMER_ID bigint, TERMINAL_ID bigint")
    got = chronological_id(df.withColumn(S.TX_US, tf.epoch_us(S.TX_DATETIME))).collect()
    assert {r[S.TX_ID]: r["CHRONO_ID"] for r in got} == {1: 0, 3: 1, 2: 2, 4: 3}

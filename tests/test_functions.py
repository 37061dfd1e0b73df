import datetime as dt

from pyspark.sql import functions as F

from txnrisk.functions.time import from_epoch_ms, night_flag, weekend_flag


def test_calendar_flags(spark):
    rows = [(dt.datetime(2024, 1, 6, 12), 1, None), (dt.datetime(2024, 1, 8, 12), 0, None),
            (dt.datetime(2024, 1, 8, 6, 59), None, 1), (dt.datetime(2024, 1, 8, 22, 0), None, 1),
            (dt.datetime(2024, 1, 8, 7, 0), None, 0), (dt.datetime(2024, 1, 8, 21, 59), None, 0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, we bigint, ni bigint")
    for r in df.select("we", "ni", weekend_flag("ts").alias("w"), night_flag("ts").alias("n")).collect():
        if r["we"] is not None:
            assert r["w"] == r["we"]
        if r["ni"] is not None:
            assert r["n"] == r["ni"]


def test_request_time_from_epoch_ms(spark):
    r = spark.range(1).select(from_epoch_ms(F.lit(1693612359000)).alias("t")).first()
    assert r["t"] == dt.datetime(2023, 9, 1, 23, 52, 39)


def test_features_do_not_depend_on_session_time_zone(spark):
    from conftest import SF0001

    from txnrisk.plans.features import feature_table
    from txnrisk.sources import load_transactions
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        ref = [tuple(r) for r in feature_table(load_transactions(spark, SF0001)).collect()]
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [tuple(r) for r in feature_table(load_transactions(spark, SF0001)).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert sorted(got) == sorted(ref)


def test_split_and_request_times_do_not_depend_on_session_time_zone(spark):
    from conftest import SF0001

    from txnrisk.operators.split import delayed_split
    from txnrisk.sources import load_transactions
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        tx = load_transactions(spark, SF0001)
        ref = sorted(r[0] for r in delayed_split(tx, "2024-01-01", 7, 7, 7, origin="2024-01-01")[1]
                     .select("TRANSACTION_ID").collect())
        ms = spark.range(1).select(from_epoch_ms(F.lit(1693612359000)).alias("t")).first()["t"]
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        got = sorted(r[0] for r in delayed_split(tx, "2024-01-01", 7, 7, 7, origin="2024-01-01")[1]
                     .select("TRANSACTION_ID").collect())
        ms2 = spark.range(1).select(from_epoch_ms(F.lit(1693612359000)).alias("t")).first()["t"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == ref and ms == ms2 == dt.datetime(2023, 9, 1, 23, 52, 39)

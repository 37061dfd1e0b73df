import math

from conftest import SF0001
from pyspark.sql import Window, functions as F

from txnrisk import schema as S
from txnrisk.operators import spatial as SPA
from txnrisk.operators.ordering import chronological_id
from txnrisk.operators.prefix import bucketed_running_sum
from txnrisk.sources import load_transactions


def test_radius_join_equals_brute_force(spark):
    tx = load_transactions(spark, SF0001)
    c = SPA.customer_points(tx).collect()
    t = SPA.terminal_points(tx).collect()
    brute = {(a[0], b[0]) for a in c for b in t
             if math.sqrt((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2) < SPA.RADIUS}
    got = {(r[0], r[1]) for r in SPA.radius_join(SPA.customer_points(tx), SPA.terminal_points(tx)).collect()}
    assert got == brute and got


def test_customer_terminal_lists(spark):
    tx = load_transactions(spark, SF0001)
    out = SPA.terminals_within_radius(SPA.customer_points(tx), SPA.terminal_points(tx))
    rows = out.collect()
    assert len(rows) == tx.select(S.CUSTOMER_ID).distinct().count()
    for r in rows:
        assert r["nb_terminals"] == len(r["available_terminals"])
        assert list(r["available_terminals"]) == sorted(r["available_terminals"])


def test_chronological_id_dense_and_ordered(spark):
    tx = load_transactions(spark, SF0001)
    got = chronological_id(tx)
    ref = tx.select(S.TX_ID, (F.row_number().over(
        Window.orderBy(S.TX_US, S.CUSTOMER_ID, S.TERMINAL_ID, S.TX_ID)) - 1).alias("ref"))
    j = got.join(ref, S.TX_ID)
    assert j.where("CHRONO_ID <> ref").count() == 0 and j.count() == tx.count()
    # the fixture's ids already follow time order
    assert got.where(F.col("CHRONO_ID") != F.col(S.TX_ID)).count() == 0


def test_bucketed_running_sum_matches_window(spark):
    df = spark.range(0, 500).select(F.col("id"), (F.col("id") % 3).alias("g"), ((F.col("id") * 7) % 11).alias("v"))
    got = bucketed_running_sum(df, ["g"], F.floor(F.col("id") / 37), [F.col("id")], {"rs": F.col("v")}, peers=False)
    w = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("id", F.sum("v").over(w).alias("ref"))
    assert got.join(ref, "id").where("rs <> ref").count() == 0


def test_rows_of_one_hour_are_numbered_by_many_tasks(spark):
    from pyspark.sql import functions as F

    from txnrisk.operators.ordering import numbered
    df = spark.range(20_000).select((F.lit(5_000_000_000) + F.pmod(F.xxhash64("id"), F.lit(3_600_000_000))).alias("t"), "id")
    out = numbered(df, ["t", "id"], "n")
    rows = out.orderBy("t", "id").collect()
    assert [r["n"] for r in rows] == list(range(20_000))
    conf = "spark.sql.adaptive.coalescePartitions.enabled"      # so few rows would go to one task otherwise
    try:
        spark.conf.set(conf, "false")
        sizes = [r["count"] for r in df.repartitionByRange("t", "id").groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)
        assert [r["n"] for r in numbered(df, ["t", "id"], "n").orderBy("t", "id").collect()] == list(range(20_000))
    finally:
        spark.conf.set(conf, "true")
    assert numbered(df.limit(0), ["t"], "n").count() == 0
    same = spark.createDataFrame([(None, 1), (None, 2), (3, 3)], "t int, v int")
    assert sorted((r["t"] is not None, r["n"]) for r in numbered(same, ["t"], "n").collect()) == [(False, 0), (False, 1), (True, 2)]


def test_a_dense_city_is_spread_and_complete(spark):
    import numpy as np

    from txnrisk.operators import spatial as SP
    rnd = np.random.default_rng(4)
    city = np.concatenate([rnd.normal(50.3, 1.0, size=(700, 2)), np.full((200, 2), 47.0), rnd.uniform(-20, 100, size=(150, 2))])
    shops = np.concatenate([rnd.normal(50, 3.0, size=(60, 2)), rnd.uniform(-20, 100, size=(60, 2)), [[52.0, 47.0], [47.0, 52.0], [50.0, 50.0]]])
    cust = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(city)], "CUSTOMER_ID long, x_customer_id double, y_customer_id double")
    term = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(shops)], "TERMINAL_ID long, x_terminal_id double, y_terminal_id double")
    gap = np.sqrt(((city[:, None, :] - shops[None, :, :]) ** 2).sum(2))
    want = sorted(zip(*map(lambda a: a.tolist(), np.nonzero(gap < 5.0))))
    for part in (8, 512):
        got = SP.radius_join(cust, term, 5.0, part_customers=part)
        assert sorted((r["CUSTOMER_ID"], r["TERMINAL_ID"]) for r in got.collect()) == want

from decimal import Decimal

from conftest import SF0001, make_tx

from txnrisk import schema as S
from txnrisk.operators import labels as LB
from txnrisk.sources import load_transactions


def test_sampled_twice_multiplies_by_25(spark):
    # customer 1 has 3 rows per day on days 0..3; two intervals of customer 1
    rows, i = [], 0
    for d in range(4):
        for h in (1, 2, 3):
            i += 1
            rows.append((i, f"2024-01-0{d + 1} 0{h}:00:00", 1, 9, 10, 0))
    tx = make_tx(spark, rows)
    civ = LB.intervals(spark.createDataFrame([(0, 1), (1, 1)], "start_day bigint, CUSTOMER_ID bigint"), 14)
    tiv = LB.intervals(spark.createDataFrame([], "start_day bigint, TERMINAL_ID bigint"), 28)
    out = LB.label_fraud(tx, tiv, civ).collect()
    sampled = LB.sample_fraction(LB.interval_matches(tx, civ, S.CUSTOMER_ID)).collect()
    k = {}
    for r in sampled:
        k[r[S.TX_ID]] = k.get(r[S.TX_ID], 0) + 1
    assert len([r for r in sampled if r[LB.START] == 0]) == 4       # floor(12 / 3)
    assert len([r for r in sampled if r[LB.START] == 1]) == 3       # floor(9 / 3)
    for r in out:
        kk = k.get(r[S.TX_ID], 0)
        assert r[S.TX_AMOUNT] == Decimal("10.00") * (5 ** kk)
        assert r[S.TX_FRAUD_SCENARIO] == (3 if kk else 0)


def test_rule_precedence(spark):
    tx = make_tx(spark, [(1, "2024-01-02 00:00:00", 1, 5, 300, 0),   # rule 1 and rule 2 -> scenario 2
                         (2, "2024-01-02 00:00:00", 2, 6, 300, 0),   # rule 1 only
                         (3, "2024-01-02 00:00:00", 3, 6, 10, 0)])   # nothing
    tiv = LB.intervals(spark.createDataFrame([(1, 5)], "start_day bigint, TERMINAL_ID bigint"), 28)
    civ = LB.intervals(spark.createDataFrame([], "start_day bigint, CUSTOMER_ID bigint"), 14)
    got = {r[S.TX_ID]: (r[S.TX_FRAUD], r[S.TX_FRAUD_SCENARIO], r["FIRST_RULE"])
           for r in LB.label_fraud(tx, tiv, civ).collect()}
    assert got == {1: (1, 2, 1), 2: (1, 1, 1), 3: (0, 0, None)}


def test_sample_per_day_sizes(spark):
    tx = load_transactions(spark, SF0001)
    last = LB.last_start_day(tx)
    s = LB.sample_per_day(tx, S.TERMINAL_ID, 2, last)
    counts = {r[0]: r[1] for r in s.groupBy(LB.START).count().collect()}
    assert sorted(counts) == list(range(last + 1)) and set(counts.values()) == {2}


def _draws(spark):
    from pyspark.sql import functions as F
    return spark.range(3000).select((F.col("id") % 5).alias(LB.START), F.col("id").alias(S.TX_ID)).union(
        spark.createDataFrame([(9, 1), (9, 2), (10, 1), (11, 1), (11, 2), (11, 3)], "a bigint, b bigint"))


def test_selection_equals_ranking(spark):
    from hashlib import md5
    rows = [tuple(r) for r in _draws(spark).collect()]
    want = set()
    for day in {d for d, _ in rows}:
        ranked = sorted((md5(f"{i}:{d}".encode()).hexdigest(), i) for d, i in rows if d == day)
        want |= {(day, i) for _, i in ranked[:len(ranked) // 3]}
    assert {tuple(r) for r in LB.sample_fraction(_draws(spark)).collect()} == want
    narrow = LB.draw_limits(_draws(spark), select_rows=2).collect()          # narrowed down digit by digit
    assert {r[LB.START] for r in narrow} == {d for d, _ in want}
    assert {(r[LB.START], r["__lid"]) for r in narrow} <= want


def test_interval_joins_against_plain_loops_without_broadcast(spark):
    tx = load_transactions(spark, SF0001).limit(600)
    ivals = [(0, 3, 1), (2, 20, 1), (5, 6, 2), (7, 7, 3), (1, 15, 4), (14, 28, 4), (3, 4, None)]
    df = spark.createDataFrame([(s, e, k) for s, e, k in ivals], f"{LB.START} bigint, {LB.END} bigint, {S.CUSTOMER_ID} bigint")
    rows = [(r[S.TX_ID], r[S.CUSTOMER_ID], r[S.TX_TIME_DAYS]) for r in tx.collect()]
    want = sorted((i, s, e) for i, c, d in rows for s, e, k in ivals if k is not None and k == c and s <= d < e)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for t in ("-1", "10MB"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", t)
            got = LB.interval_matches(tx, df, S.CUSTOMER_ID)
            assert sorted((r[S.TX_ID], r[LB.START], r[LB.END]) for r in got.collect()) == want
            flagged = {r[S.TX_ID] for r in LB.in_intervals(tx, df, S.CUSTOMER_ID, "hit").where("hit").collect()}
            assert flagged == {i for i, _, _ in want}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(want) > 0

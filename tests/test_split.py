from conftest import SF0001, make_tx

from txnrisk import schema as S
from txnrisk.operators.split import cv_folds, delayed_split
from txnrisk.sources import load_transactions


def _ids(df):
    return sorted(r[S.TX_ID] for r in df.select(S.TX_ID).collect())


def _daily_rows(spark, frauds):
    """one row per customer 1..3 per day for 30 days; frauds: {(customer, day)}"""
    rows, i = [], 0
    for d in range(30):
        for c in (1, 2, 3):
            i += 1
            rows.append((i, f"2024-01-{d + 1:02d} 12:00:00", c, 1, 5, 1 if (c, d) in frauds else 0))
    return make_tx(spark, rows)


def test_known_customer_timing(spark):
    # start day 0, 7/7/7: test days 14..20
    tx = _daily_rows(spark, {(1, 7), (2, 6)})
    _, test = delayed_split(tx, "2024-01-01", 7, 7, 7)
    got = {(r[S.CUSTOMER_ID], r[S.TX_TIME_DAYS]) for r in test.collect()}
    # customer 1 (fraud on day 7) is kept on day 14 and dropped from day 15 on
    assert (1, 14) in got and all((1, d) not in got for d in range(15, 21))
    # customer 2 (fraud on day 6, inside train) is dropped throughout
    assert all((2, d) not in got for d in range(14, 21))
    assert all((3, d) in got for d in range(14, 21))


def test_empty_train_gives_empty_test(spark):
    tx = _daily_rows(spark, set())
    train, test = delayed_split(tx, "2025-01-01", 7, 7, 7)
    assert train.count() == 0 and test.count() == 0


def test_split_sizes_match_fixture(spark):
    train, test = delayed_split(load_transactions(spark, SF0001), "2024-01-01", 7, 7, 7)
    assert train.count() == 248 and test.count() == 130


def test_folds_do_not_overlap(spark):
    f = cv_folds(load_transactions(spark, SF0001), "2024-01-08", 2, 7, 7, 7)
    tr = f.where("role = 'train'").groupBy("fold").agg({"TX_TIME_DAYS": "max"}).collect()
    va = f.where("role = 'val'").groupBy("fold").agg({"TX_TIME_DAYS": "min"}).collect()
    tmax = {r["fold"]: r[1] for r in tr}
    vmin = {r["fold"]: r[1] for r in va}
    for k in vmin:
        assert vmin[k] - tmax[k] > 7


def test_fold_zero_equals_delayed_split(spark):
    tx = load_transactions(spark, SF0001)
    f = cv_folds(tx, "2024-01-08", 2, 7, 7, 7)
    train, test = delayed_split(tx, "2024-01-08", 7, 7, 7)
    assert _ids(f.where("fold = 0 AND role = 'train'")) == _ids(train)
    assert _ids(f.where("fold = 0 AND role = 'val'")) == _ids(test)


def _naive_split(pdf, start, train, delay, test):
    """Day-by-day rule: the known set grows with each day's frauds before the test day."""
    import datetime as dt
    st = dt.datetime.fromisoformat(start)
    tr = pdf[(pdf.TX_DATETIME >= st) & (pdf.TX_DATETIME < st + dt.timedelta(days=train))]
    if tr.empty:
        return set(tr.TRANSACTION_ID), set()
    known = set(tr[tr.TX_FRAUD == 1].CUSTOMER_ID)
    s = tr.TX_TIME_DAYS.min()
    out = set()
    for k in range(test):
        day = pdf[pdf.TX_TIME_DAYS == s + train + delay + k]
        prev = pdf[(pdf.TX_TIME_DAYS == s + train + k - 1) & (pdf.TX_FRAUD == 1)]
        known |= set(prev.CUSTOMER_ID)
        out |= set(day[~day.CUSTOMER_ID.isin(known)].TRANSACTION_ID)
    return set(tr.TRANSACTION_ID), out


def test_split_matches_day_loop(spark):
    tx = load_transactions(spark, SF0001)
    pdf = tx.select(S.TX_ID, S.TX_DATETIME, S.CUSTOMER_ID, S.TX_TIME_DAYS, S.TX_FRAUD).toPandas()
    for start, tr_d, de_d, te_d in [("2024-01-01", 7, 7, 7), ("2024-01-03", 5, 0, 4), ("2024-01-02", 3, 2, 9),
                                    ("2024-01-10", 7, 7, 7), ("2024-01-05", 1, 1, 1), ("2024-02-20", 7, 7, 7)]:
        train, test = delayed_split(tx, start, tr_d, de_d, te_d)
        want_train, want_test = _naive_split(pdf, start, tr_d, de_d, te_d)
        assert set(_ids(train)) == want_train, (start, tr_d, de_d, te_d)
        assert set(_ids(test)) == want_test, (start, tr_d, de_d, te_d)


def test_every_fold_equals_its_delayed_split(spark):
    import datetime as dt
    tx = load_transactions(spark, SF0001)
    f = cv_folds(tx, "2024-01-15", 3, 5, 3, 4)
    for i in range(3):
        start = (dt.datetime(2024, 1, 15) - dt.timedelta(days=4 * i)).isoformat()
        train, test = delayed_split(tx, start, 5, 3, 4)
        assert _ids(f.where(f"fold = {i} AND role = 'train'")) == _ids(train)
        assert _ids(f.where(f"fold = {i} AND role = 'val'")) == _ids(test)


def test_origin_predicates_change_nothing_and_push_down(spark):
    tx = load_transactions(spark, SF0001)
    a_train, a_test = delayed_split(tx, "2024-01-01", 7, 7, 7)
    b_train, b_test = delayed_split(tx, "2024-01-01", 7, 7, 7, origin="2024-01-01")
    assert _ids(a_test) == _ids(b_test) and _ids(a_train) == _ids(b_train)
    plan = b_test._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-15" in plan


def test_train_test_features_equal_the_split_of_the_feature_table(spark):
    """One table of features holds both sides, and the split is the one of the whole feature table."""
    import datetime as dt

    from conftest import SF0001
    from txnrisk.operators.split import delayed_split
    from txnrisk.plans.features import feature_table_between
    from txnrisk.plans.training import train_test_features
    from txnrisk.sources import load_transactions
    tx = load_transactions(spark, SF0001)
    feat = feature_table_between(tx, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 30))
    want = delayed_split(feat, "2024-01-02", 7, 7, 7)
    train, test = train_test_features(tx, "2024-01-02")
    for got, side in zip((train, test), want):
        assert sorted(got.collect(), key=str) == sorted(side.select(got.columns).collect(), key=str) and got.count()
    assert "Window" not in train._jdf.queryExecution().toString()
    assert "/features-" in train.inputFiles()[0]

import re

import pytest
from conftest import SF0001, make_tx

from txnrisk import schema as S
from txnrisk.operators.rolling import customer_spending_windows, delayed_risk_windows
from txnrisk.plans.features import feature_table
from txnrisk.sources import load_transactions

STRATS = [dict(strategy="frame"), dict(strategy="events"), dict(strategy="auto", hot_rows=1)]


def _by_id(df, cols):
    return {r[S.TX_ID]: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("kw", STRATS)
def test_frame_edge_exactly_n_days(spark, kw):
    tx = make_tx(spark, [
        (1, "2024-01-01 10:00:00", 1, 1, 1, 0),
        (2, "2024-01-02 10:00:00", 1, 1, 10, 0),            # exactly 1 day later: row 1 outside
        (3, "2024-01-05 10:00:00", 2, 1, 1, 0),
        (4, "2024-01-06 09:59:59.999999", 2, 1, 10, 0),     # 1 us less: row 3 inside
    ])
    out = _by_id(customer_spending_windows(tx, (1,), **kw), ["CUSTOMER_ID_NB_TX_1DAY_WINDOW"])
    assert out == {1: (1,), 2: (1,), 3: (1,), 4: (2,)}


@pytest.mark.parametrize("kw", STRATS)
def test_equal_timestamps_are_peers(spark, kw):
    tx = make_tx(spark, [
        (1, "2024-01-01 00:00:00", 1, 1, 1, 0),
        (2, "2024-01-02 00:00:00", 1, 1, 10, 0),
        (3, "2024-01-02 00:00:00", 1, 1, 100, 0),
        (4, "2024-01-03 00:00:00", 1, 1, 1000, 0),
    ])
    out = _by_id(customer_spending_windows(tx, (1,), **kw),
                 ["CUSTOMER_ID_NB_TX_1DAY_WINDOW", "CUSTOMER_ID_AVG_AMOUNT_1DAY_WINDOW"])
    assert out == {1: (1, 1.0), 2: (2, 55.0), 3: (2, 55.0), 4: (1, 1000.0)}


@pytest.mark.parametrize("kw", STRATS)
def test_delayed_window(spark, kw):
    tx = make_tx(spark, [
        (1, "2024-01-01 12:00:00", 1, 7, 1, 1),
        (2, "2024-01-08 12:00:00", 2, 7, 1, 0),             # t + 7d: sees the fraud for N=1
        (3, "2024-01-08 11:59:59.999999", 3, 7, 1, 0),      # t + 7d - 1us: not yet
        (4, "2024-01-09 12:00:00", 4, 7, 1, 0),             # t + 8d: already out
    ])
    out = _by_id(delayed_risk_windows(tx, 7, (1,), **kw),
                 ["TERMINAL_ID_NB_TX_1DAY_WINDOW", "TERMINAL_ID_RISK_1DAY_WINDOW"])
    assert out[2] == (1, 1.0)
    assert out[3] == (0, 0.0)
    # row 4's frame is (t, t + 1d]: the fraud sits on the open bound, nothing else is inside
    assert out[4] == (0, 0.0)


def test_first_rows_golden(spark):
    """First row of a customer: count 1, mean = own amount; first terminal rows 0 / 0."""
    f = feature_table(load_transactions(spark, SF0001))
    first = f.orderBy(S.TX_US).first()
    assert first["CUSTOMER_ID_NB_TX_1DAY_WINDOW"] == 1
    assert first["CUSTOMER_ID_AVG_AMOUNT_1DAY_WINDOW"] == float(first[S.TX_AMOUNT])
    assert first["TERMINAL_ID_NB_TX_30DAY_WINDOW"] == 0 and first["TERMINAL_ID_RISK_30DAY_WINDOW"] == 0.0


def test_strategies_agree_on_data(spark):
    tx = load_transactions(spark, SF0001)
    ref = feature_table(tx, strategy="frame")
    for kw in [dict(strategy="events"), dict(strategy="auto", hot_rows=5)]:
        got = feature_table(tx, **kw)
        assert got.count() == ref.count()
        assert got.exceptAll(ref).count() == 0


def test_window_properties(spark):
    f = feature_table(load_transactions(spark, SF0001))
    bad = f.where("CUSTOMER_ID_NB_TX_1DAY_WINDOW > CUSTOMER_ID_NB_TX_7DAY_WINDOW "
                  "OR CUSTOMER_ID_NB_TX_7DAY_WINDOW > CUSTOMER_ID_NB_TX_30DAY_WINDOW "
                  "OR TERMINAL_ID_RISK_7DAY_WINDOW < 0 OR TERMINAL_ID_RISK_7DAY_WINDOW > 1")
    assert bad.count() == 0


def test_null_keys_dropped(spark):
    tx = make_tx(spark, [(1, "2024-01-01 00:00:00", None, 1, 1, 0), (2, "2024-01-01 00:00:01", 1, 1, 1, 0)])
    assert customer_spending_windows(tx).count() == 1


def test_sliced_features_equal_full_history(spark):
    """Windows (1, 3) with delay 2 look back 5 days: slicing from Jan 20 cuts real history."""
    from pyspark.sql import functions as F

    from txnrisk.plans.features import feature_table_between
    tx = load_transactions(spark, SF0001)
    full = feature_table(tx, windows=(1, 3), delay=2).where(
        (F.col(S.TX_DATETIME) >= "2024-01-20") & (F.col(S.TX_DATETIME) < "2024-01-26"))
    part = feature_table_between(tx, "2024-01-20", "2024-01-26", windows=(1, 3), delay=2)
    assert part.count() == full.count() > 0
    assert part.exceptAll(full).count() == 0
    # the slice really cut history: features over the sliced input alone differ
    naive = feature_table(tx.where(F.col(S.TX_DATETIME) >= "2024-01-20"), windows=(1, 3), delay=2)
    assert naive.exceptAll(full).count() > 0


def test_frames_only_grow(spark):
    """No frame slides: each row of a key is added once per bound, not once per frame that holds it."""
    df = make_tx(spark, [(i, f"2024-01-{1 + i % 20:02d} 10:00:00", i % 3, i % 2, 5 + i, i % 2) for i in range(60)])
    for fn in (customer_spending_windows, delayed_risk_windows):
        plan = fn(df, strategy="frame")._jdf.queryExecution().toString().lower()
        frames = re.findall(r"specifiedwindowframe\(rangeframe, ([^,]*),", plan)
        assert frames and set(frames) == {"unboundedpreceding$()"}, set(frames)

from conftest import SF0001, make_tx
from pyspark.sql import functions as F

from txnrisk import schema as S
from txnrisk.operators.snapshot import (customer_snapshot, customer_snapshot_of, terminal_snapshot,
                                        terminal_snapshot_of)
from txnrisk.plans.features import feature_table
from txnrisk.sources import load_transactions


def _same(a, b):
    assert a.columns == b.columns and a.count() == b.count()
    assert a.exceptAll(b).count() == 0


def test_direct_snapshots_equal_the_last_feature_rows(spark):
    tx = load_transactions(spark, SF0001)
    feat = feature_table(tx)
    _same(customer_snapshot_of(tx), customer_snapshot(feat))
    _same(terminal_snapshot_of(tx), terminal_snapshot(feat))


def test_direct_snapshots_on_ties_nulls_and_window_edges(spark):
    tx = make_tx(spark, [
        (1, "2024-01-01 10:00:00", 1, 7, 10, 1), (2, "2024-01-02 10:00:00", 1, 7, 20, 0), (3, "2024-01-09 10:00:00", 1, 7, 5, 0),
        (4, "2024-01-09 10:00:00", 1, 8, 7, 1), (5, "2024-01-09 11:00:00", 1, None, 9, 0), (6, "2024-01-03 10:00:00", None, 8, 4, 1),
        (7, "2024-01-05 00:00:00", 2, None, 4, 0), (8, "2024-01-30 00:00:00", 3, 8, 2, 0)])
    tx = tx.withColumn(S.TX_AMOUNT, F.when(F.col(S.TX_ID) != 4, F.col(S.TX_AMOUNT)))
    feat = feature_table(tx)
    _same(customer_snapshot_of(tx), customer_snapshot(feat))
    _same(terminal_snapshot_of(tx), terminal_snapshot(feat))

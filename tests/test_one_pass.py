"""Work that is done once: transactions and request records are parsed, and inputs scaled, in one go."""

import datetime as dt

import numpy as np
from conftest import make_tx
from pyspark.sql import functions as F

from txnrisk.ml import frame as MF, logit as LG
from txnrisk.plans.training import train_test_features
from txnrisk.sources import requests as RQ


def _rows(n):
    day = lambda i: (dt.datetime(2024, 1, 1) + dt.timedelta(hours=i * 28 * 24 / n)).isoformat(sep=" ")
    return [(i, day(i), i % 7, i % 5, 10 + i % 90, int(i % 11 == 0)) for i in range(n)]


def test_a_split_reads_its_transactions_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def terminal(k):
        read.add(1)
        return k

    tx = make_tx(spark, _rows(200)).withColumn("TERMINAL_ID", terminal("TERMINAL_ID"))
    train, test = train_test_features(tx, "2024-01-01")
    assert train.count() > 0 and test.count() > 0
    assert read.value == 200


def test_one_group_is_scaled_without_a_join(spark):
    cols = ["TX_AMOUNT", "TX_TIME_DAYS"]
    tx = make_tx(spark, _rows(60)).withColumn("TX_AMOUNT", F.when(F.col("TRANSACTION_ID") % 9 > 0, F.col("TX_AMOUNT")))
    scaling = MF.fit_scaling(tx, cols)
    one = MF.inputs(tx, scaling)
    assert "Join" not in one._jdf.queryExecution().optimizedPlan().toString()
    both = MF.inputs(tx, scaling, F.lit(0))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, both.collect()))
    nobody = tx.where("false")
    assert MF.inputs(nobody, MF.fit_scaling(nobody, cols)).count() == 0


def test_passes_read_packed_rows(spark):
    rng = np.random.default_rng(1)
    n = 5 * LG.PACK * LG.PACKS // 2 + 7
    x, g = rng.normal(size=(n, 3)), rng.integers(0, 2, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-x[:, 0] - g))).astype(float)
    rows = spark.createDataFrame([(int(g[i]), x[i].tolist(), float(y[i]), i) for i in range(n)],
                                 "grp long, x array<double>, y double, h long").coalesce(1)
    packs = LG.packed(rows)
    assert packs.count() < n / 8
    few, many = ([LG.Logit(f"f{k}", group, C=1.0 + k) for k in range(m) for group in (0, 1)] for m in (1, LG.SINGLE + 1))
    a, b = (LG.fit_logits(rows, s, 3, {0: int((g == 0).sum()), 1: int((g == 1).sum())}) for s in (few, many))
    for spec in few:
        mine = g == spec.group
        one = np.column_stack([x[mine], np.ones(mine.sum())])
        slope = one.T @ (1 / (1 + np.exp(-one @ a[spec])) - y[mine]) + np.append(a[spec][:3], 0)
        assert np.abs(slope).max() < 1e-5
        assert np.allclose(a[spec], b[spec], atol=1e-9)


def test_a_request_record_is_parsed_once(spark):
    lines = spark.createDataFrame([(None,), ("",), ("{}",), ("x{",), ('{"TRANSACTION_ID": 1, "TX_DATETIME": "soon"}',),
                                   ('{"TRANSACTION_ID": 2}',), ('{"TRANSACTION_ID": 3, "TX_DATETIME": 1704067200000, "CUSTOMER_ID": 4}',)], "value string")
    parsed = RQ.sort_out_lines(lines)
    plan = parsed.requests._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    assert [r["TRANSACTION_ID"] for r in parsed.requests.orderBy("TRANSACTION_ID").collect()] == [2, 3]
    assert sorted(r[0] for r in parsed.quarantined.collect()) == sorted(["", "", "{}", "x{", '{"TRANSACTION_ID": 1, "TX_DATETIME": "soon"}'])

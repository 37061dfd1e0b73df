import math
import random

import pytest

from txnrisk.operators.metrics import (cv_summary, mean_precision_top_k, precision_top_k, ranking_metrics,
                                       select_one_sd, threshold_metrics)


def _brute_ap_auc(rows):
    """rows: (score, label).  AP as the step sum over distinct thresholds; AUC with ties = 1/2."""
    pos = sum(y for _, y in rows)
    neg = len(rows) - pos
    ap, tp, n = 0.0, 0, 0
    for s in sorted({s for s, _ in rows}, reverse=True):
        grp = [y for sc, y in rows if sc == s]
        tp += sum(grp)
        n += len(grp)
        ap += sum(grp) / pos * tp / n
    auc = 0.0
    for s1, y1 in rows:
        if y1 != 1:
            continue
        for s0, y0 in rows:
            if y0 == 0:
                auc += 1.0 if s1 > s0 else (0.5 if s1 == s0 else 0.0)
    return ap, auc / (pos * neg)


@pytest.mark.parametrize("buckets", [1, 4, 256])
def test_ranking_metrics_vs_brute_force(spark, buckets):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 20) / 20.0, 1 if rnd.random() < 0.2 else 0, i % 3) for i in range(400)]
    df = spark.createDataFrame(rows, "TRANSACTION_ID bigint, score double, TX_FRAUD bigint, g bigint")
    got = {r["g"]: r for r in ranking_metrics(df, group_cols=["g"], n_buckets=buckets).collect()}
    for g in range(3):
        ap, auc = _brute_ap_auc([(s, y) for _, s, y, gg in rows if gg == g])
        assert math.isclose(got[g]["average_precision"], ap, rel_tol=1e-12)
        assert math.isclose(got[g]["auc"], auc, rel_tol=1e-12)


def test_constant_score_is_prevalence(spark):
    rows = [(i, 0.03, 1 if i < 7 else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "TRANSACTION_ID bigint, score double, TX_FRAUD bigint")
    r = ranking_metrics(df).first()
    assert math.isclose(r["average_precision"], 0.07) and r["auc"] == 0.5
    t = threshold_metrics(df).first()
    assert math.isclose(t["acc"], 0.93) and t["f1_score"] == 0.0 and t["gmean"] == 0.0


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(1, 0.5, 1), (2, 0.51, 1), (3, 0.2, 0), (4, 0.9, 0)],
                               "TRANSACTION_ID bigint, score double, TX_FRAUD bigint")
    t = threshold_metrics(df).first()
    assert (t["tp"], t["fp"], t["tn"], t["fn"]) == (1, 1, 1, 1)
    assert math.isclose(t["gmean"], 0.5)


def test_top_k_more_than_rows(spark):
    df = spark.createDataFrame([(1, 0.9, 1, 0), (2, 0.8, 0, 0), (3, 0.7, 1, 1)],
                               "TRANSACTION_ID bigint, score double, TX_FRAUD bigint, TX_TIME_DAYS bigint")
    p = {r["TX_TIME_DAYS"]: r["precision_top_k"] for r in precision_top_k(df, k=100).collect()}
    assert p == {0: 0.5, 1: 1.0}
    assert mean_precision_top_k(df, k=1).first()["mean_precision_top_k"] == 1.0


def test_cv_summary_golden(spark):
    """Five fold scores -> mean .612339, std (ddof 0) .022347, bounds .567645 / .657033."""
    scores = [.652561, .601248, .612506, .610476, .584905]
    df = spark.createDataFrame([("lr", i, s) for i, s in enumerate(scores)], "config string, fold bigint, score double")
    r = cv_summary(df).first()
    assert round(r["mean_test_score"], 6) == 0.612339
    assert round(r["std_test_score"], 6) == 0.022347
    assert round(r["lower_bd"], 6) == 0.567645 and round(r["upper_bd"], 6) == 0.657033
    assert r["rank_test_score"] == 1


def test_one_sd_rule(spark):
    """means .70 .69 .60 .40: threshold .70 - .13913 = .56087 -> picks .60"""
    rows = [(c, 5, m, 0.0, rk, 0.0, 0.0) for c, m, rk in [("a", .70, 1), ("b", .69, 2), ("c", .60, 3), ("d", .40, 4)]]
    df = spark.createDataFrame(rows, "config string, n_folds bigint, mean_test_score double, std_test_score double, "
                                     "rank_test_score bigint, lower_bd double, upper_bd double")
    r = select_one_sd(df).first()
    assert r["config"] == "c"
    assert round(r["threshold"], 5) == 0.56087


def test_each_group_has_edges_of_its_own(spark):
    """A group whose scores lie within 1e-6 is spread over buckets like the others."""
    from pyspark.sql import functions as F

    from txnrisk.operators.metrics import _score_buckets
    df = spark.range(4000).select((F.col("id") % 2).alias("g"), F.when(F.col("id") % 2 == 0, F.col("id") / 4000)
                                  .otherwise(0.5 + F.col("id") / 4e9).alias("score"))
    got = _score_buckets(df, "score", 8, ["g"]).groupBy("g", "__sb").count().collect()
    assert {(r["g"], r["__sb"]) for r in got} == {(g, float(b)) for g in (0, 1) for b in range(8)}
    assert all(200 < r["count"] < 300 for r in got)

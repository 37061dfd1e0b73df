"""Evaluation aggregates (E1-E9) as Spark aggregations.

All metrics are exact (no binning).  Threshold metrics are one aggregate.
ROC-AUC and average precision need cumulative counts in descending score
order; instead of one global ordered window (one task), scores are first
grouped (map-side combine), then cut into ~quantile buckets and summed with
:func:`bucketed_running_sum`, so the ordered pass is spread over buckets.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from .. import schema as S
from ..functions.numeric import safe_ratio
from ..session import write_scratch
from .prefix import bucketed_running_sum

# distinct scores per bucket of the ordered pass, and buckets at most
SCORES_PER_BUCKET = 20_000
MAX_SCORE_BUCKETS = 4_096


def threshold_metrics(scored: DataFrame, label: str = S.TX_FRAUD, score: str = "score",
                      threshold: float = S.DECISION_THRESHOLD, group_cols: list[str] = ()) -> DataFrame:
    """Accuracy, F1 of class 1 and G-mean at ``score > threshold``.
    Rows without a score take no part, as in :func:`ranking_metrics`."""
    scored = scored.where(F.col(score).isNotNull())
    pred = F.col(score) > F.lit(threshold)
    y = F.col(label) == 1
    c = scored.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & ~y).alias("tn"), F.count_if(~pred & y).alias("fn"))
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    return c.select(
        *group_cols, "n", "tp", "fp", "tn", "fn",
        safe_ratio(tp + tn, F.col("n")).alias("acc"),
        safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        F.sqrt(safe_ratio(tp, tp + fn) * safe_ratio(tn, tn + fp)).alias("gmean"))


def _score_buckets(g: DataFrame, score: str, n_buckets: int, group_cols: list[str] = ()) -> DataFrame:
    """Attach ``__sb``, a monotone bucket number of the score within its group: how many of the group's
    own quantile edges (of its distinct scores) lie below.  The edges are a table, joined by group;
    none reaches the driver."""
    if n_buckets <= 1:
        return g.withColumn("__sb", F.lit(0.0))
    probs = F.array(*[F.lit(i / n_buckets) for i in range(1, n_buckets)])
    edges = write_scratch(g.groupBy(*[F.col(c).alias(f"__e_{c}") for c in group_cols])
                          .agg(F.array_distinct(F.percentile_approx(score, probs, 10 * n_buckets)).alias("__edges")), "edges")
    same = F.lit(True)
    for c in group_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"__e_{c}"))
    # binary search, in generated code: each step takes half of what may lie below (an edge beyond the last is null)
    found = g.join(edges, same).withColumn("__sb", F.lit(0))
    for half in (1 << k for k in reversed(range(n_buckets.bit_length()))):
        lies_below = F.get("__edges", F.col("__sb") + F.lit(half - 1)) < F.col(score)
        found = found.withColumn("__sb", F.col("__sb") + F.when(lies_below, F.lit(half)).otherwise(F.lit(0)))
    return found.select(*g.columns, F.col("__sb").cast("double").alias("__sb"))


def ranking_metrics(scored: DataFrame, label: str = S.TX_FRAUD, score: str = "score",
                    group_cols: list[str] = (), n_buckets: int | None = None) -> DataFrame:
    """Exact ROC-AUC (ties count half) and average precision
    (step sum of precision at each distinct score, recall increments)."""
    group_cols = list(group_cols)
    # the scored rows are evaluated once: quantiles and sums both read this narrow table
    g = write_scratch(scored.where(F.col(score).isNotNull())
                      .groupBy(*group_cols, score)
                      .agg(F.sum(F.col(label).cast("bigint")).alias("tp"), F.count(F.lit(1)).alias("cnt")), "scores")
    if n_buckets is None:
        largest = g.groupBy(*group_cols).count().agg(F.max("count")).first()[0] or 0
        n_buckets = max(1, min(MAX_SCORE_BUCKETS, math.ceil(largest / SCORES_PER_BUCKET)))
    g = _score_buckets(g, score, n_buckets, group_cols)
    run = bucketed_running_sum(g, group_cols, -F.col("__sb"), [F.col(score).desc()],
                               {"ctp": F.col("tp"), "ccnt": F.col("cnt")}, peers=True)
    agg = run.groupBy(*group_cols).agg(
        F.sum("tp").alias("pos"), F.sum("cnt").alias("tot"),
        F.sum(F.col("tp").cast("double") * F.col("ctp").cast("double") / F.col("ccnt").cast("double")).alias("ap_num"),
        F.sum((F.col("cnt") - F.col("tp")).cast("double")
              * ((F.col("ctp") - F.col("tp")).cast("double") + F.col("tp").cast("double") / 2)).alias("auc_num"))
    pos, neg = F.col("pos").cast("double"), (F.col("tot") - F.col("pos")).cast("double")
    return agg.select(
        *group_cols, F.col("tot").alias("n"), F.col("pos").alias("n_pos"),
        F.when(F.col("pos") > 0, F.col("ap_num") / pos).alias("average_precision"),
        F.when((F.col("pos") > 0) & (neg > 0), F.col("auc_num") / (pos * neg)).alias("auc"))


def top_k_per_group(scored: DataFrame, k: int = S.TOP_K, group: str = S.TX_TIME_DAYS,
                    score: str = "score", tie: str = S.TX_ID) -> DataFrame:
    """O3: the k highest scores of each group (ties by ``tie`` ascending).

    ``row_number() <= k`` plans as WindowGroupLimit, applied before the
    shuffle too, so each map task ships at most k rows per group."""
    w = Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(tie).asc())
    return scored.select("*", F.row_number().over(w).alias("rank")).where(F.col("rank") <= k)


def precision_top_k(scored: DataFrame, k: int = S.TOP_K, group: str = S.TX_TIME_DAYS,
                    score: str = "score", label: str = S.TX_FRAUD, tie: str = S.TX_ID,
                    group_cols: list[str] = ()) -> DataFrame:
    """Per group (within ``group_cols``), the share of frauds among its k
    best-scored rows (a group with fewer than k rows averages what it has)."""
    keys = [*group_cols, group]
    return (top_k_per_group(scored, k, keys, score, tie)
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_top"), F.sum(F.col(label).cast("bigint")).alias("n_hit"))
            .select(*keys, "n_top", "n_hit", safe_ratio("n_hit", "n_top").alias("precision_top_k")))


def mean_precision_top_k(scored: DataFrame, k: int = S.TOP_K, group: str = S.TX_TIME_DAYS,
                         score: str = "score", label: str = S.TX_FRAUD, tie: str = S.TX_ID,
                         group_cols: list[str] = ()) -> DataFrame:
    """Unweighted mean of the per-group precision (honours ``k``)."""
    return precision_top_k(scored, k, group, score, label, tie, group_cols).groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.avg("precision_top_k").alias("mean_precision_top_k"))


def cv_summary(fold_scores: DataFrame, config: str = "config", score: str = "score") -> DataFrame:
    """Per config the mean, population std, rank (ties share the lowest
    rank) and mean +/- 2 std of its fold scores.  One row per config."""
    agg = fold_scores.groupBy(config).agg(
        F.count(F.lit(1)).alias("n_folds"),
        F.avg(score).alias("mean_test_score"),
        F.stddev_pop(score).alias("std_test_score"))
    # the ranked relation has one row per configuration: a bounded set
    w = Window.orderBy(F.col("mean_test_score").desc())
    return agg.select(
        config, "n_folds", "mean_test_score", "std_test_score",
        F.rank().over(w).cast("bigint").alias("rank_test_score"),
        (F.col("mean_test_score") - 2 * F.col("std_test_score")).alias("lower_bd"),
        (F.col("mean_test_score") + 2 * F.col("std_test_score")).alias("upper_bd"))


def select_one_sd(summary: DataFrame, config: str = "config") -> DataFrame:
    """Among configs whose mean is strictly above max(mean) - std(mean)
    (sample std over configs), the one with the lowest mean; ties by rank,
    then config.  Returns one row."""
    # the summary holds one row per configuration (bounded), so whole-table
    # windows are cheap here
    every = Window.partitionBy()
    thr = (F.max("mean_test_score").over(every)
           - F.coalesce(F.stddev_samp("mean_test_score").over(every), F.lit(0.0)))
    cand = summary.select("*", thr.alias("threshold")).where(F.col("mean_test_score") > F.col("threshold"))
    w = Window.orderBy(F.col("mean_test_score").asc(), F.col("rank_test_score").asc(), F.col(config).asc())
    return (cand.select("*", F.row_number().over(w).alias("__r")).where("__r = 1")
            .select(config, "mean_test_score", "std_test_score", "rank_test_score", "threshold"))

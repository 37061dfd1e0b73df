"""Model training, comparison and evaluation jobs (M5, M14, E1-E5 per model)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, functions as F

from .. import schema as S
from ..ml.pipeline import PROB
from ..session import write_scratch
from ..operators.metrics import ranking_metrics, threshold_metrics
from ..functions.time import ntz_literal
from ..operators.split import day_range, exclude_known, first_train_day, known_customers, train_window
from .features import feature_table_between, look_back

# The model families compared by the leaderboard, with their default settings
# (fixed values of the workload: kNN k = 5; logistic C = 1; bagging 10 trees;
# forest 100 trees; boosting 100 stages, rate 0.1, depth 3).
DEFAULT_MODELS = {
    "knn": ("knn", {"k": 5}),
    "logistic": ("logistic", {}),
    "tree": ("tree", {}),
    "bagging": ("bagging", {"n_estimators": 10}),
    "rf": ("forest", {"n_estimators": 100}),
    "GradientBoost": ("gbt", {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3}),
}
METRIC_COLS = ["acc", "f1_score", "gmean", "auc", "average_precision"]


def train_test_features(tx: DataFrame, start, delta_train=7, delta_delay=7, delta_test=7,
                        persist: bool = True) -> tuple[DataFrame, DataFrame]:
    """Feature table -> delayed split.  The features of both sides' rows are written once (they feed
    many fits), and so are the transactions in reach of them, which six jobs read; ``persist=False``
    leaves both to the caller's plan.

    The split is decided on the transactions, and features are computed only up to its last test day
    (from the windows' look-back on): the test period ends at most 2 * train + delay + test days after
    ``start``."""
    import datetime as dt
    st = dt.datetime.fromisoformat(start) if isinstance(start, str) else start
    end = st + dt.timedelta(days=2 * delta_train + delta_delay + delta_test)
    if persist:
        tx = write_scratch(tx.where((F.col(S.TX_DATETIME) >= ntz_literal(look_back(st))) & (F.col(S.TX_DATETIME) < ntz_literal(end))), "transactions")
    # the rows that the feature table keeps
    rows = tx.where(F.col(S.CUSTOMER_ID).isNotNull() & F.col(S.TERMINAL_ID).isNotNull()
                    & (F.col(S.TX_DATETIME) >= ntz_literal(st)) & (F.col(S.TX_DATETIME) < ntz_literal(end)))
    s = first_train_day(train_window(rows, start, delta_train))
    if s is None:                                              # empty train set gives an empty test set
        feat = feature_table_between(tx, st, end)
        return train_window(feat, start, delta_train), feat.limit(0)
    d0 = s + delta_train + delta_delay
    d1 = d0 + delta_test - 1
    feat = feature_table_between(tx.where(F.col(S.TX_TIME_DAYS) <= d1), st, end)
    in_train = (F.col(S.TX_DATETIME) >= ntz_literal(st)) & (F.col(S.TX_DATETIME) < ntz_literal(st + dt.timedelta(days=delta_train)))
    feat = feat.where(in_train | day_range(d0, d1))
    if persist:
        feat = write_scratch(feat, "features")
    known = known_customers(rows, train_window(rows, start, delta_train), s, delta_train, delta_test)
    test = exclude_known(feat.where(day_range(d0, d1)), known, delta_delay)
    return train_window(feat, start, delta_train), write_scratch(test, "test") if persist else test


def evaluate(scored: DataFrame, name: str, prob: str = PROB, label: str = S.TX_FRAUD) -> DataFrame:
    """One row: clf, acc, f1_score, gmean, auc, average_precision.

    Both inputs are single-row aggregates; they are stacked (each filling its
    own columns) and folded into one row by a global aggregate, not joined."""
    scored = write_scratch(scored.select(F.col(label).cast("bigint").alias(label), prob), "scored")   # the model runs once
    thr = threshold_metrics(scored, label, prob).select(
        "acc", "f1_score", "gmean", F.lit(None).cast("double").alias("auc"),
        F.lit(None).cast("double").alias("average_precision"))
    rk = ranking_metrics(scored, label, prob).select(
        *[F.lit(None).cast("double").alias(c) for c in ("acc", "f1_score", "gmean")], "auc", "average_precision")
    both = thr.unionByName(rk)
    return both.agg(*[F.max(c).alias(c) for c in METRIC_COLS]).select(F.lit(name).alias("clf"), *METRIC_COLS)


def dummy_scored(train: DataFrame, test: DataFrame, label: str = S.TX_FRAUD) -> DataFrame:
    """M5: every test row scored with the train fraud rate."""
    rate = train.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0
    return test.withColumn(PROB, F.lit(float(rate)))


def fit_and_evaluate(train: DataFrame, test: DataFrame, name: str, kind: str, **params) -> DataFrame:
    if kind == "knn":
        from ..ml.knn import knn_scores
        return evaluate(knn_scores(train, test, k=params.get("k", 5)), name)
    from ..ml.tuning import fit_config, predict
    return evaluate(predict(fit_config(train, kind, params), test), name)


def leaderboard(train: DataFrame, test: DataFrame, models: dict = None, parallelism: int = 4) -> DataFrame:
    """Dummy + every model, one metrics row each, sorted by average precision.

    Fits are independent Spark jobs; a small driver thread pool keeps the
    cluster busy with several at once."""
    models = models or DEFAULT_MODELS
    rows = [evaluate(dummy_scored(train, test), "dummy")]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        futs = [pool.submit(fit_and_evaluate, train, test, name, kind, **params)
                for name, (kind, params) in models.items()]
        rows += [f.result() for f in futs]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.orderBy(F.col("average_precision").asc_nulls_first(), F.col("clf"))

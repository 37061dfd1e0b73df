"""Named queries over the driver tables.

Every query reads ``events`` (through the transactions view) or data Spark
derives from it, so its work grows with the input.  ``ORACLE_SQL`` holds the
independent DuckDB formulation of each SQL-expressible key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schema as S
from ..operators.calendar import add_calendar_flags
from ..operators.rolling import customer_spending_windows, delayed_risk_windows
from ..plans.features import feature_table
from ..sources.transactions import (EVENTS_ORIGIN, LABELLED_SCHEMA, load_transactions, read_transactions,
                                    write_transactions)
from . import sqltext as Q

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def _tx(spark: SparkSession, sf: str) -> DataFrame:
    return load_transactions(spark, sf)


def _feat(spark: SparkSession, sf: str) -> DataFrame:
    return feature_table(_tx(spark, sf))


def _ratio(num, den):
    return (F.col(num) if isinstance(num, str) else num).cast("double") / \
        (F.col(den) if isinstance(den, str) else den).cast("double")


CUST = S.customer_feature_names()
TERM = S.terminal_feature_names()

# ---------------------------------------------------------------- step 1 ---


@register("calendar_flags", f"""WITH {Q.TX}
SELECT TRANSACTION_ID, {Q.FLAGS} FROM tx""")
def calendar_flags(spark, sf):
    return add_calendar_flags(_tx(spark, sf)).select(S.TX_ID, S.WEEKEND, S.NIGHT)


@register("customer_rolling", f"""WITH {Q.TX}
SELECT TRANSACTION_ID, CUSTOMER_ID, {Q.customer_cols()}
FROM tx WHERE CUSTOMER_ID IS NOT NULL""")
def customer_rolling(spark, sf):
    tx = _tx(spark, sf).select(S.TX_ID, S.CUSTOMER_ID, S.TX_US, S.TX_AMOUNT)
    return customer_spending_windows(tx).select(S.TX_ID, S.CUSTOMER_ID, *CUST)


@register("fraud_rate", f"""WITH {Q.TX}
SELECT count(*) AS n_tx, CAST(sum(TX_FRAUD) AS BIGINT) AS n_fraud,
       CAST(sum(TX_FRAUD) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS fraud_rate FROM tx""")
def fraud_rate(spark, sf):
    return _tx(spark, sf).agg(F.count(F.lit(1)).alias("n_tx"), F.sum(S.TX_FRAUD).alias("n_fraud")) \
        .select("n_tx", "n_fraud", _ratio("n_fraud", "n_tx").alias("fraud_rate"))


@register("amount_by_class", f"""WITH {Q.TX}
SELECT TX_FRAUD, count(*) AS n_tx,
       CAST(sum(TX_AMOUNT) AS DOUBLE) / CAST(count(TX_AMOUNT) AS DOUBLE) AS mean_amount
FROM tx GROUP BY TX_FRAUD""")
def amount_by_class(spark, sf):
    return (_tx(spark, sf).groupBy(S.TX_FRAUD)
            .agg(F.count(F.lit(1)).alias("n_tx"), F.sum(S.TX_AMOUNT).alias("s"), F.count(S.TX_AMOUNT).alias("c"))
            .select(S.TX_FRAUD, "n_tx", _ratio("s", "c").alias("mean_amount")))


# ---------------------------------------------------------------- step 2 ---


@register("terminal_risk", f"""WITH {Q.TX}
SELECT TRANSACTION_ID, TERMINAL_ID, {Q.terminal_cols()}
FROM tx WHERE TERMINAL_ID IS NOT NULL""")
def terminal_risk(spark, sf):
    tx = _tx(spark, sf).select(S.TX_ID, S.TERMINAL_ID, S.TX_US, S.TX_FRAUD)
    return delayed_risk_windows(tx).select(S.TX_ID, S.TERMINAL_ID, *TERM)


@register("feature_table", f"""WITH {Q.TX}, {Q.FEAT}
SELECT * REPLACE (CAST(TX_AMOUNT AS DOUBLE) AS TX_AMOUNT) FROM feat""")
def feature_table_q(spark, sf):
    return _amount_as_double(_feat(spark, sf))


def _amount_as_double(df):
    """Amounts leave the registry as doubles (exact decimals inside)."""
    return df.withColumn(S.TX_AMOUNT, F.col(S.TX_AMOUNT).cast("double"))


def _class_means_sql(cols: list[str], digits: int = 9) -> str:
    parts = ",\n  ".join(f"round(avg({c}), {digits}) AS {c}" for c in cols)
    return f"""WITH {Q.TX}, {Q.FEAT}
SELECT TX_FRAUD, count(*) AS n_tx,
  {parts}
FROM feat GROUP BY TX_FRAUD"""


def _class_means(df: DataFrame, cols: list[str], digits: int = 9) -> DataFrame:
    return df.groupBy(S.TX_FRAUD).agg(
        F.count(F.lit(1)).alias("n_tx"),
        *[F.round(F.avg(c).cast("double"), digits).alias(c) for c in cols])


@register("flags_by_class", _class_means_sql([S.WEEKEND, S.NIGHT]))
def flags_by_class(spark, sf):
    keyed = _tx(spark, sf).where(F.col(S.CUSTOMER_ID).isNotNull() & F.col(S.TERMINAL_ID).isNotNull())
    return _class_means(add_calendar_flags(keyed), [S.WEEKEND, S.NIGHT])   # no windows needed


@register("customer_feats_by_class", _class_means_sql(CUST))
def customer_feats_by_class(spark, sf):
    return _class_means(_feat(spark, sf), CUST)


@register("terminal_feats_by_class", _class_means_sql(TERM))
def terminal_feats_by_class(spark, sf):
    return _class_means(_feat(spark, sf), TERM)


# ---------------------------------------------------------------- step 3 ---
from ..operators import split as SP  # noqa: E402

# Parameters of the registered split queries: a 7/7/7 split from the first day
# and two sequential folds (the only 7/7/7 folds 30 days of events can hold).
SPLIT_START, TRAIN_D, DELAY_D, TEST_D = "2024-01-01", 7, 7, 7
CV_START, N_FOLDS = "2024-01-08", 2
_SPLIT = Q.split_ctes(SPLIT_START, TRAIN_D, DELAY_D, TEST_D)
_FOLDS = Q.fold_ctes(CV_START, N_FOLDS, TRAIN_D, DELAY_D, TEST_D)
_ROWCOLS = [S.TX_ID, S.CUSTOMER_ID, S.TX_TIME_DAYS, S.TX_FRAUD]


def _split(spark, sf, tx=None):
    return SP.delayed_split(tx if tx is not None else _tx(spark, sf), SPLIT_START, TRAIN_D, DELAY_D, TEST_D,
                            origin=EVENTS_ORIGIN)


def _folds(spark, sf, tx=None):
    return SP.cv_folds(tx if tx is not None else _tx(spark, sf), CV_START, N_FOLDS, TRAIN_D, DELAY_D, TEST_D)


@register("train_window", f"""WITH {Q.TX}, {_SPLIT}
SELECT TRANSACTION_ID, CUSTOMER_ID, TX_TIME_DAYS, TX_FRAUD FROM trn""")
def train_window_q(spark, sf):
    return SP.train_window(_tx(spark, sf), SPLIT_START, TRAIN_D).select(*_ROWCOLS)


@register("known_customers", f"""WITH {Q.TX}, {_SPLIT}
SELECT CUSTOMER_ID, min(kd) AS KNOWN_DAY FROM (
  SELECT CUSTOMER_ID, (SELECT s FROM s) AS kd FROM trn WHERE TX_FRAUD = 1
  UNION ALL
  SELECT CUSTOMER_ID, TX_TIME_DAYS FROM tx, s WHERE TX_FRAUD = 1
     AND TX_TIME_DAYS BETWEEN s.s + {TRAIN_D - 1} AND s.s + {TRAIN_D + TEST_D - 2}) k
GROUP BY CUSTOMER_ID""")
def known_customers_q(spark, sf):
    tx = _tx(spark, sf)
    train = SP.train_window(tx, SPLIT_START, TRAIN_D)
    s = SP.first_train_day(train)
    return SP.known_customers(tx, train, s, TRAIN_D, TEST_D)


@register("exclude_known", f"""WITH {Q.TX}, {_SPLIT}
SELECT TRANSACTION_ID, CUSTOMER_ID, TX_TIME_DAYS, TX_FRAUD FROM tst""")
def exclude_known_q(spark, sf):
    return _split(spark, sf)[1].select(*_ROWCOLS)


@register("delayed_split", f"""WITH {Q.TX}, {_SPLIT}
SELECT 'train' AS role, TRANSACTION_ID FROM trn UNION ALL SELECT 'test' AS role, TRANSACTION_ID FROM tst""")
def delayed_split_q(spark, sf):
    train, test = _split(spark, sf)
    return train.select(F.lit("train").alias("role"), S.TX_ID).unionByName(
        test.select(F.lit("test").alias("role"), S.TX_ID))


@register("split_ranges", f"""WITH {Q.TX}, {_SPLIT}
SELECT role, count(*) AS n_rows, CAST(sum(TX_FRAUD) AS BIGINT) AS n_fraud,
       strftime(min(TX_DATETIME), '%Y-%m-%d') AS first_day, strftime(max(TX_DATETIME), '%Y-%m-%d') AS last_day,
       CAST(min(TX_AMOUNT) AS DOUBLE) AS min_amount, CAST(max(TX_AMOUNT) AS DOUBLE) AS max_amount,
       CAST(sum(TX_AMOUNT) AS DOUBLE) AS sum_amount
FROM (SELECT 'train' AS role, * FROM trn UNION ALL SELECT 'test' AS role, * FROM tst) u GROUP BY role""")
def split_ranges(spark, sf):
    train, test = _split(spark, sf)
    u = train.withColumn("role", F.lit("train")).unionByName(test.withColumn("role", F.lit("test")))
    return _ranges(u, ["role"])


def _ranges(df, keys):
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(S.TX_FRAUD).alias("n_fraud"),
        F.date_format(F.min(S.TX_DATETIME), "yyyy-MM-dd").alias("first_day"),
        F.date_format(F.max(S.TX_DATETIME), "yyyy-MM-dd").alias("last_day"),
        F.min(S.TX_AMOUNT).cast("double").alias("min_amount"),
        F.max(S.TX_AMOUNT).cast("double").alias("max_amount"),
        F.sum(S.TX_AMOUNT).cast("double").alias("sum_amount"))


@register("daily_frauds", f"""WITH {Q.TX}, {_SPLIT}
SELECT count(*) AS n_days, CAST(sum(n) AS BIGINT) AS n_fraud, CAST(sum(n) AS DOUBLE) / count(*) AS mean_daily_frauds
FROM (SELECT TX_TIME_DAYS, sum(TX_FRAUD) AS n FROM tst GROUP BY TX_TIME_DAYS) d""")
def daily_frauds(spark, sf):
    test = _split(spark, sf)[1]
    per_day = test.groupBy(S.TX_TIME_DAYS).agg(F.sum(S.TX_FRAUD).alias("n"))
    return per_day.agg(F.count(F.lit(1)).alias("n_days"), F.sum("n").alias("n_fraud")) \
        .select("n_days", "n_fraud", _ratio("n_fraud", "n_days").alias("mean_daily_frauds"))


@register("cv_folds", f"""WITH {Q.TX}, {_FOLDS}
SELECT fold, role, TRANSACTION_ID FROM cvf""")
def cv_folds_q(spark, sf):
    return _folds(spark, sf).select(SP.FOLD, SP.ROLE, S.TX_ID)


# the workload's five folds, with 3/3/3 days so that 30 days hold them
CV5_START, CV5_DAYS = "2024-01-13", 3


@register("cv_folds_five", f"""WITH {Q.TX}, {Q.fold_ctes(CV5_START, 5, CV5_DAYS, CV5_DAYS, CV5_DAYS)}
SELECT fold, role, TRANSACTION_ID FROM cvf""")
def cv_folds_five(spark, sf):
    return SP.cv_folds(_tx(spark, sf), CV5_START, 5, CV5_DAYS, CV5_DAYS, CV5_DAYS).select(SP.FOLD, SP.ROLE, S.TX_ID)


@register("fold_ranges", f"""WITH {Q.TX}, {_FOLDS}
SELECT fold, role, count(*) AS n_rows, CAST(sum(TX_FRAUD) AS BIGINT) AS n_fraud,
       strftime(min(TX_DATETIME), '%Y-%m-%d') AS first_day, strftime(max(TX_DATETIME), '%Y-%m-%d') AS last_day,
       CAST(min(TX_AMOUNT) AS DOUBLE) AS min_amount, CAST(max(TX_AMOUNT) AS DOUBLE) AS max_amount,
       CAST(sum(TX_AMOUNT) AS DOUBLE) AS sum_amount
FROM cvf GROUP BY fold, role""")
def fold_ranges(spark, sf):
    return _ranges(_folds(spark, sf), [SP.FOLD, SP.ROLE])


@register("fold_rows", f"""WITH {Q.TX}, {_FOLDS}
SELECT c.fold, c.role, t.TRANSACTION_ID, CAST(t.TX_AMOUNT AS DOUBLE) AS TX_AMOUNT, t.TX_FRAUD
FROM (SELECT fold, role, TRANSACTION_ID FROM cvf) c JOIN tx t ON t.TRANSACTION_ID = c.TRANSACTION_ID""")
def fold_rows(spark, sf):
    """Select rows by an id relation (the fold index), as a join on the id."""
    tx = _tx(spark, sf)
    ids = _folds(spark, sf, tx).select(SP.FOLD, SP.ROLE, S.TX_ID)
    return _amount_as_double(ids.join(tx.select(S.TX_ID, S.TX_AMOUNT, S.TX_FRAUD), S.TX_ID, "inner")
                             .select(SP.FOLD, SP.ROLE, S.TX_ID, S.TX_AMOUNT, S.TX_FRAUD))


# ---------------------------------------------------------------- step 4 ---
from ..operators import metrics as M  # noqa: E402

R9 = 9  # digits kept for floating aggregates whose summation order is engine-specific
_SCORE_SQL = "CAST(floor(TX_AMOUNT) AS DOUBLE) / 500"
_SC = f"sc AS (SELECT *, {_SCORE_SQL} AS score FROM tst)"


def amount_score():
    """A deterministic stand-in score with ties: floor(amount) / 500."""
    return F.floor(F.col(S.TX_AMOUNT)).cast("double") / F.lit(500.0)


def _scored_test(spark, sf):
    return _split(spark, sf)[1].withColumn("score", amount_score())


def _r(cols, digits=R9):
    return [F.round(F.col(c), digits).alias(c) for c in cols]


@register("threshold_metrics", f"""WITH {Q.TX}, {_SPLIT}, {_SC}
SELECT n, tp, fp, tn, fn,
  round(CAST(tp + tn AS DOUBLE) / n, {R9}) AS acc,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END, {R9}) AS f1_score,
  round(sqrt((CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END)
           * (CASE WHEN tn + fp = 0 THEN 0.0 ELSE CAST(tn AS DOUBLE) / (tn + fp) END)), {R9}) AS gmean
FROM (SELECT count(*) AS n,
        count(*) FILTER (WHERE score > 0.5 AND TX_FRAUD = 1) AS tp,
        count(*) FILTER (WHERE score > 0.5 AND TX_FRAUD <> 1) AS fp,
        count(*) FILTER (WHERE NOT score > 0.5 AND TX_FRAUD <> 1) AS tn,
        count(*) FILTER (WHERE NOT score > 0.5 AND TX_FRAUD = 1) AS fn FROM sc) c""")
def threshold_metrics_q(spark, sf):
    m = M.threshold_metrics(_scored_test(spark, sf))
    return m.select("n", "tp", "fp", "tn", "fn", *_r(["acc", "f1_score", "gmean"]))


@register("roc_auc", f"""WITH {Q.TX}, {_SPLIT}, {_SC}
SELECT n, n_pos, auc FROM ({Q.ranking_sql("sc")}) r""")
def roc_auc_q(spark, sf):
    return M.ranking_metrics(_scored_test(spark, sf)).select("n", "n_pos", *_r(["auc"]))


@register("average_precision", f"""WITH {Q.TX}, {_SPLIT}, {_SC}
SELECT n, n_pos, average_precision FROM ({Q.ranking_sql("sc")}) r""")
def average_precision_q(spark, sf):
    return M.ranking_metrics(_scored_test(spark, sf)).select("n", "n_pos", *_r(["average_precision"]))


_TOPK = f"""tk AS (SELECT TX_TIME_DAYS, TRANSACTION_ID, TX_FRAUD, score,
   row_number() OVER (PARTITION BY TX_TIME_DAYS ORDER BY score DESC, TRANSACTION_ID) AS rank FROM sc),
tk2 AS (SELECT * FROM tk WHERE rank <= {S.TOP_K}),
pk AS (SELECT TX_TIME_DAYS, count(*) AS n_top, CAST(sum(TX_FRAUD) AS BIGINT) AS n_hit,
              CAST(sum(TX_FRAUD) AS DOUBLE) / count(*) AS precision_top_k FROM tk2 GROUP BY TX_TIME_DAYS)"""


@register("top_k_per_day", f"""WITH {Q.TX}, {_SPLIT}, {_SC}, {_TOPK}
SELECT TX_TIME_DAYS, TRANSACTION_ID, score, rank FROM tk2""")
def top_k_per_day(spark, sf):
    return M.top_k_per_group(_scored_test(spark, sf), S.TOP_K) \
        .select(S.TX_TIME_DAYS, S.TX_ID, "score", F.col("rank").cast("bigint").alias("rank"))


@register("precision_top_k", f"""WITH {Q.TX}, {_SPLIT}, {_SC}, {_TOPK}
SELECT * FROM pk""")
def precision_top_k_q(spark, sf):
    return M.precision_top_k(_scored_test(spark, sf), S.TOP_K)


@register("precision_top_k_avg", f"""WITH {Q.TX}, {_SPLIT}, {_SC}, {_TOPK}
SELECT count(*) AS n_groups, round(avg(precision_top_k), {R9}) AS mean_precision_top_k FROM pk""")
def precision_top_k_avg(spark, sf):
    return M.mean_precision_top_k(_scored_test(spark, sf), S.TOP_K) \
        .select("n_groups", *_r(["mean_precision_top_k"]))


# Deterministic scorers standing in for model configurations in the CV keys.
CV_CONFIGS = {
    "amount": ("CAST(floor(TX_AMOUNT) AS DOUBLE) / 500",
               lambda: F.floor(F.col(S.TX_AMOUNT)).cast("double") / F.lit(500.0)),
    "terminal_risk_7d": ("TERMINAL_ID_RISK_7DAY_WINDOW", lambda: F.col("TERMINAL_ID_RISK_7DAY_WINDOW")),
    "terminal_risk_30d": ("TERMINAL_ID_RISK_30DAY_WINDOW", lambda: F.col("TERMINAL_ID_RISK_30DAY_WINDOW")),
    "amount_vs_mean_30d": ("CAST(TX_AMOUNT AS DOUBLE) / CUSTOMER_ID_AVG_AMOUNT_30DAY_WINDOW",
                           lambda: F.col(S.TX_AMOUNT).cast("double") / F.col("CUSTOMER_ID_AVG_AMOUNT_30DAY_WINDOW")),
}
_CFG_CASE = "CASE cfg.config " + " ".join(
    f"WHEN '{k}' THEN CAST({sql} AS DOUBLE)" for k, (sql, _) in CV_CONFIGS.items()) + " END"
_CV_SQL_CTES = f"""{Q.TX}, {Q.FEAT}, {Q.fold_ctes(CV_START, N_FOLDS, TRAIN_D, DELAY_D, TEST_D, src="feat")},
cvs AS (SELECT c.fold, c.TRANSACTION_ID, c.TX_FRAUD, cfg.config, {_CFG_CASE} AS score
        FROM cvf c, (VALUES {", ".join(f"('{k}')" for k in CV_CONFIGS)}) cfg(config) WHERE c.role = 'val'),
fsc AS (SELECT config, fold, average_precision AS score FROM ({Q.ranking_sql("cvs", ["config", "fold"], digits=None)}) r),
summ AS (SELECT config, count(*) AS n_folds, round(avg(score), {R9}) AS mean_test_score,
                round(stddev_pop(score), {R9}) AS std_test_score,
                CAST(rank() OVER (ORDER BY avg(score) DESC) AS BIGINT) AS rank_test_score,
                round(avg(score) - 2 * stddev_pop(score), {R9}) AS lower_bd,
                round(avg(score) + 2 * stddev_pop(score), {R9}) AS upper_bd
         FROM fsc GROUP BY config)"""


def _fold_feat(spark, sf):
    """Features for the folds' time range only (plus the windows' look-back)."""
    import datetime as dt
    from ..plans.features import feature_table_between
    st = dt.datetime.fromisoformat(CV_START)
    lo = st - dt.timedelta(days=(N_FOLDS - 1) * TEST_D)
    hi = st + dt.timedelta(days=2 * TRAIN_D + DELAY_D + TEST_D)
    return feature_table_between(_tx(spark, sf), lo, hi)


def _cv_scored(spark, sf):
    feat = _fold_feat(spark, sf)
    val = _folds(spark, sf, feat).where(F.col(SP.ROLE) == "val")
    cfgs = F.array(*[F.struct(F.lit(k).alias("config"), fn().cast("double").alias("score"))
                     for k, (_, fn) in CV_CONFIGS.items()])
    return val.select(SP.FOLD, S.TX_ID, S.TX_FRAUD, F.inline(cfgs))


def _fold_scores(spark, sf):
    r = M.ranking_metrics(_cv_scored(spark, sf), group_cols=["config", SP.FOLD])
    return r.select("config", SP.FOLD, F.col("average_precision").alias("score"))


def _summary(spark, sf):
    s = M.cv_summary(_fold_scores(spark, sf))
    return s.select("config", "n_folds", *_r(["mean_test_score", "std_test_score"]), "rank_test_score",
                    *_r(["lower_bd", "upper_bd"]))


@register("cv_fold_scores", f"""WITH {_CV_SQL_CTES}
SELECT config, fold, round(score, {R9}) AS score FROM fsc""")
def cv_fold_scores(spark, sf):
    return _fold_scores(spark, sf).select("config", SP.FOLD, *_r(["score"]))


@register("cv_summary", f"""WITH {_CV_SQL_CTES}
SELECT * FROM summ""")
def cv_summary_q(spark, sf):
    return _summary(spark, sf)


@register("select_one_sd", f"""WITH {_CV_SQL_CTES},
th AS (SELECT max(mean_test_score) - coalesce(stddev_samp(mean_test_score), 0) AS threshold FROM summ)
SELECT config, mean_test_score, std_test_score, rank_test_score, round(threshold, {R9}) AS threshold
FROM summ, th WHERE mean_test_score > threshold
ORDER BY mean_test_score, rank_test_score, config LIMIT 1""")
def select_one_sd_q(spark, sf):
    return M.select_one_sd(_summary(spark, sf)).select(
        "config", "mean_test_score", "std_test_score", "rank_test_score", *_r(["threshold"]))


# ---------------------------------------------------------------- step 5 ---
from ..operators import snapshot as SN  # noqa: E402
from ..sources import requests as RQ  # noqa: E402

# Snapshots are frozen from the days before SERVE_DAY; requests are the rows
# from SERVE_DAY on, sent as JSON lines with epoch-millisecond times.
SERVE_DAY = 21


def _snap_sql(key, cols, where=""):
    return f"""SELECT {key}, TX_DATETIME, {", ".join(cols)} FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY TX_US DESC, TRANSACTION_ID DESC) AS rn
  FROM feat {where}) z WHERE rn = 1"""


_REQ = f"""req AS (SELECT TRANSACTION_ID, make_timestamp(CAST(floor(TX_US / 1000) AS BIGINT) * 1000) AS TX_DATETIME,
  CUSTOMER_ID, TERMINAL_ID, CAST(TX_AMOUNT AS DOUBLE) AS TX_AMOUNT FROM tx WHERE TX_TIME_DAYS >= {SERVE_DAY}),
reqf AS (SELECT *, {Q.FLAGS} FROM req)"""
_SNAPS = f"""snc AS ({_snap_sql("CUSTOMER_ID", CUST, f"WHERE TX_TIME_DAYS < {SERVE_DAY}")}),
snt AS ({_snap_sql("TERMINAL_ID", TERM, f"WHERE TX_TIME_DAYS < {SERVE_DAY}")})"""


@register("customer_snapshot", f"""WITH {Q.TX}, {Q.FEAT}
{_snap_sql("CUSTOMER_ID", CUST)}""")
def customer_snapshot_q(spark, sf):
    return SN.customer_snapshot_of(_tx(spark, sf))


@register("terminal_snapshot", f"""WITH {Q.TX}, {Q.FEAT}
{_snap_sql("TERMINAL_ID", TERM)}""")
def terminal_snapshot_q(spark, sf):
    return SN.terminal_snapshot_of(_tx(spark, sf))


def _requests(spark, sf, tx=None):
    tx = tx if tx is not None else _tx(spark, sf)
    lines = RQ.requests_from_transactions(tx.where(F.col(S.TX_TIME_DAYS) >= SERVE_DAY))
    return add_calendar_flags(RQ.parse_request_lines(lines))


def _written_tx(spark, sf):
    """The transactions, parsed once for all that reads them."""
    return write_scratch(_tx(spark, sf), "transactions")


def _frozen_snapshots(spark, sf, tx=None):
    tx = tx if tx is not None else _written_tx(spark, sf)
    past = tx.where(F.col(S.TX_TIME_DAYS) < SERVE_DAY)
    return SN.customer_snapshot_of(past), SN.terminal_snapshot_of(past)


@register("parse_requests", f"""WITH {Q.TX}, {_REQ}
SELECT * FROM reqf""")
def parse_requests(spark, sf):
    return _requests(spark, sf)


def _request_lines(spark, sf):
    """(id, line): the JSON request of each transaction from SERVE_DAY on."""
    tx = _tx(spark, sf).where(F.col(S.TX_TIME_DAYS) >= SERVE_DAY)
    return tx.select(S.TX_ID, RQ.request_line().alias("value"))


@register("parse_request_arrays", f"""WITH {Q.TX}, {_REQ}
SELECT * FROM reqf""")
def parse_request_arrays(spark, sf):
    """The same requests as array bodies of up to a hundred records."""
    bodies = _request_lines(spark, sf).groupBy(F.floor(F.col(S.TX_ID) / 100)).agg(
        F.concat(F.lit("["), F.concat_ws(", ", F.collect_list("value")), F.lit("]")).alias("body"))
    return add_calendar_flags(RQ.parse_request_arrays(bodies))


@register("request_quarantine", f"""WITH {Q.TX}
SELECT kind, count(*) AS n, CAST(sum(CUSTOMER_ID) AS BIGINT) AS customers FROM (
  SELECT CASE WHEN TRANSACTION_ID % 7 < 3 THEN 'quarantined' ELSE 'scored' END AS kind, CUSTOMER_ID FROM tx WHERE TX_TIME_DAYS >= {SERVE_DAY}) r
GROUP BY kind""")
def request_quarantine(spark, sf):
    """Requests of which three in seven are damaged: cut off, without an id, with a time that is none."""
    lines, third = _request_lines(spark, sf), F.col(S.TX_ID) % 7
    broken = (F.when(third == 0, F.expr("left(value, length(value) - 1)"))
              .when(third == 1, F.regexp_replace("value", '"TRANSACTION_ID":[0-9]+,?', ""))
              .when(third == 2, F.regexp_replace("value", '"TX_DATETIME":[0-9]+', '"TX_DATETIME":"soon"')).otherwise(F.col("value")))
    parsed = RQ.sort_out_lines(lines.select(broken.alias("value")))
    customer = F.regexp_extract(RQ.RAW, '"CUSTOMER_ID":([0-9]+)', 1).try_cast("bigint")
    both = (parsed.requests.select(F.lit("scored").alias("kind"), S.CUSTOMER_ID)
            .unionByName(parsed.quarantined.select(F.lit("quarantined").alias("kind"), customer.alias(S.CUSTOMER_ID))))
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum(S.CUSTOMER_ID).alias("customers"))


@register("enrich_customer", f"""WITH {Q.TX}, {Q.FEAT}, {_REQ}, {_SNAPS}
SELECT reqf.*, {", ".join("snc." + c for c in CUST)} FROM reqf LEFT JOIN snc USING (CUSTOMER_ID)""")
def enrich_customer(spark, sf):
    tx = _written_tx(spark, sf)
    snc, _ = _frozen_snapshots(spark, sf, tx)
    return SN.enrich(_requests(spark, sf, tx), snc, S.CUSTOMER_ID)


@register("enrich_full", f"""WITH {Q.TX}, {Q.FEAT}, {_REQ}, {_SNAPS}
SELECT reqf.*, {", ".join("snc." + c for c in CUST)}, {", ".join("snt." + c for c in TERM)}
FROM reqf LEFT JOIN snc USING (CUSTOMER_ID) LEFT JOIN snt USING (TERMINAL_ID)""")
def enrich_full(spark, sf):
    tx = _written_tx(spark, sf)
    snc, snt = _frozen_snapshots(spark, sf, tx)
    return SN.enrich(SN.enrich(_requests(spark, sf, tx), snc, S.CUSTOMER_ID), snt, S.TERMINAL_ID)


# ---------------------------------------------------------------- step 6 ---
from ..functions import time as TF  # noqa: E402
from ..operators import labels as LB  # noqa: E402
from ..operators import spatial as SPA  # noqa: E402
from ..operators.ordering import chronological_id  # noqa: E402


def _md5sql(idc, day):
    return f"md5(CAST({idc} AS VARCHAR) || ':' || CAST({day} AS VARCHAR))"


def _sample_sql(ent_sql, idc, n, days):
    # day d takes the n entities that follow md5(d) in md5 order
    return f"""SELECT d.start_day, e.{idc}, d.start_day + {days} AS end_day
   FROM (SELECT range AS start_day FROM range(0, (SELECT max(TX_TIME_DAYS) FROM tx))) d, range({n}) j(k),
     (SELECT {idc}, row_number() OVER (ORDER BY md5(CAST({idc} AS VARCHAR)), {idc}) - 1 AS r, count(*) OVER () AS nn FROM ({ent_sql}) x) e
 WHERE j.k < e.nn AND e.r = (CAST('0x' || substr(md5(CAST(d.start_day AS VARCHAR)), 1, 8) AS BIGINT) + j.k) % e.nn"""


_IVALS = f"""tiv AS ({_sample_sql("SELECT DISTINCT TERMINAL_ID FROM tx WHERE TERMINAL_ID IS NOT NULL", "TERMINAL_ID",
                                 S.TERMINALS_PER_DAY, S.TERMINAL_COMPROMISE_DAYS)}),
civ AS ({_sample_sql("SELECT DISTINCT CUSTOMER_ID FROM tx WHERE CUSTOMER_ID IS NOT NULL", "CUSTOMER_ID",
                     S.CUSTOMERS_PER_DAY, S.CUSTOMER_COMPROMISE_DAYS)}),
cm AS (SELECT civ.start_day, tx.* FROM tx JOIN civ ON tx.CUSTOMER_ID = civ.CUSTOMER_ID
       AND tx.TX_TIME_DAYS >= civ.start_day AND tx.TX_TIME_DAYS < civ.end_day),
smp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY start_day ORDER BY {_md5sql("TRANSACTION_ID", "start_day")}, TRANSACTION_ID) AS rn,
                       count(*) OVER (PARTITION BY start_day) AS n FROM cm) z WHERE rn <= floor(n / 3)),
kk AS (SELECT TRANSACTION_ID, count(*) AS k FROM smp GROUP BY TRANSACTION_ID),
lab AS (SELECT tx.TRANSACTION_ID,
   CASE WHEN kk.k > 0 THEN CAST(tx.TX_AMOUNT * CAST(pow(5, kk.k) AS DECIMAL(20,0)) AS DECIMAL(18,2)) ELSE tx.TX_AMOUNT END AS TX_AMOUNT,
   tx.TX_AMOUNT > 220 AS r1,
   EXISTS (SELECT 1 FROM tiv WHERE tiv.TERMINAL_ID = tx.TERMINAL_ID AND tx.TX_TIME_DAYS >= tiv.start_day
           AND tx.TX_TIME_DAYS < tiv.end_day) AS r2,
   coalesce(kk.k, 0) AS k
  FROM tx LEFT JOIN kk ON tx.TRANSACTION_ID = kk.TRANSACTION_ID
  WHERE tx.CUSTOMER_ID IS NOT NULL AND tx.TERMINAL_ID IS NOT NULL)"""


def _ivals(tx):
    last = LB.last_start_day(tx)
    tiv = LB.intervals(LB.sample_per_day(tx, S.TERMINAL_ID, S.TERMINALS_PER_DAY, last), S.TERMINAL_COMPROMISE_DAYS)
    civ = LB.intervals(LB.sample_per_day(tx, S.CUSTOMER_ID, S.CUSTOMERS_PER_DAY, last), S.CUSTOMER_COMPROMISE_DAYS)
    return tiv, civ


def _keyed_tx(spark, sf):
    return _tx(spark, sf).where(F.col(S.CUSTOMER_ID).isNotNull() & F.col(S.TERMINAL_ID).isNotNull())


def _labelled(spark, sf):
    tx = _keyed_tx(spark, sf)
    tiv, civ = _ivals(tx)
    return LB.label_fraud(tx, tiv, civ)


@register("label_amount_rule", f"""WITH {Q.TX}
SELECT TRANSACTION_ID, CAST(TX_AMOUNT > 220 AS BIGINT) AS TX_FRAUD,
       CAST(CASE WHEN TX_AMOUNT > 220 THEN 1 ELSE 0 END AS BIGINT) AS TX_FRAUD_SCENARIO FROM tx""")
def label_amount_rule(spark, sf):
    r1 = LB.amount_rule()
    return _tx(spark, sf).select(S.TX_ID, r1.cast("bigint").alias(S.TX_FRAUD),
                                 F.when(r1, 1).otherwise(0).cast("bigint").alias(S.TX_FRAUD_SCENARIO))


@register("sample_n_per_day", f"""WITH {Q.TX}, {_IVALS}
SELECT 'terminal' AS kind, start_day, TERMINAL_ID AS id FROM tiv
UNION ALL SELECT 'customer' AS kind, start_day, CUSTOMER_ID AS id FROM civ""")
def sample_n_per_day(spark, sf):
    tiv, civ = _ivals(_keyed_tx(spark, sf))
    return tiv.select(F.lit("terminal").alias("kind"), LB.START, F.col(S.TERMINAL_ID).alias("id")).unionByName(
        civ.select(F.lit("customer").alias("kind"), LB.START, F.col(S.CUSTOMER_ID).alias("id")))


@register("label_terminal_intervals", f"""WITH {Q.TX}, {_IVALS}
SELECT TRANSACTION_ID, TERMINAL_ID, TX_TIME_DAYS FROM tx
WHERE CUSTOMER_ID IS NOT NULL AND EXISTS (SELECT 1 FROM tiv WHERE tiv.TERMINAL_ID = tx.TERMINAL_ID
  AND tx.TX_TIME_DAYS >= tiv.start_day AND tx.TX_TIME_DAYS < tiv.end_day)""")
def label_terminal_intervals(spark, sf):
    tx = _keyed_tx(spark, sf)
    tiv, _ = _ivals(tx)
    return LB.in_intervals(tx.select(S.TX_ID, S.TERMINAL_ID, S.TX_TIME_DAYS), tiv, S.TERMINAL_ID, "hit") \
        .where("hit").drop("hit")


@register("customer_interval_matches", f"""WITH {Q.TX}, {_IVALS}
SELECT start_day, TRANSACTION_ID FROM cm WHERE TERMINAL_ID IS NOT NULL""")
def customer_interval_matches(spark, sf):
    tx = _keyed_tx(spark, sf)
    _, civ = _ivals(tx)
    return LB.interval_matches(tx, civ, S.CUSTOMER_ID).select(LB.START, S.TX_ID)


@register("sample_third", f"""WITH {Q.TX}, {_IVALS}
SELECT start_day, TRANSACTION_ID FROM smp""")
def sample_third(spark, sf):
    tx = _keyed_tx(spark, sf)
    _, civ = _ivals(tx)
    return LB.sample_fraction(LB.interval_matches(tx, civ, S.CUSTOMER_ID)).select(LB.START, S.TX_ID)


@register("label_fraud", f"""WITH {Q.TX}, {_IVALS}
SELECT TRANSACTION_ID, CAST(TX_AMOUNT AS DOUBLE) AS TX_AMOUNT,
  CAST(k > 0 OR r2 OR r1 AS BIGINT) AS TX_FRAUD,
  CAST(CASE WHEN k > 0 THEN 3 WHEN r2 THEN 2 WHEN r1 THEN 1 ELSE 0 END AS BIGINT) AS TX_FRAUD_SCENARIO
FROM lab""")
def label_fraud_q(spark, sf):
    return _amount_as_double(_labelled(spark, sf).select(S.TX_ID, S.TX_AMOUNT, S.TX_FRAUD, S.TX_FRAUD_SCENARIO))


@register("labelled_features", f"""WITH {Q.TX}, {_IVALS},
ltx AS (SELECT tx.* REPLACE (lab.TX_AMOUNT AS TX_AMOUNT, CAST(lab.k > 0 OR lab.r2 OR lab.r1 AS BIGINT) AS TX_FRAUD),
   CAST(CASE WHEN lab.k > 0 THEN 3 WHEN lab.r2 THEN 2 WHEN lab.r1 THEN 1 ELSE 0 END AS BIGINT) AS TX_FRAUD_SCENARIO
  FROM tx JOIN lab ON lab.TRANSACTION_ID = tx.TRANSACTION_ID),
{Q.FEAT.replace("FROM tx ", "FROM ltx ")}, {Q.split_ctes(SPLIT_START, TRAIN_D, DELAY_D, TEST_D, src="feat")}
SELECT part, TRANSACTION_ID, CAST(TX_AMOUNT AS DOUBLE) AS TX_AMOUNT, TX_FRAUD, TX_FRAUD_SCENARIO, {", ".join(TERM)}
FROM (SELECT 'train' AS part, * FROM trn UNION ALL SELECT 'test' AS part, * FROM tst) z""")
def labelled_features(spark, sf):
    """The chain of the workload: label, store by day, read back, features, split."""
    path = scratch_path(spark, f"labelled-{uuid.uuid4().hex}")
    write_transactions(_labelled(spark, sf).drop("FIRST_RULE"), path)
    tx = read_transactions(spark, path, LABELLED_SCHEMA)
    train, test = SP.delayed_split(feature_table(tx), SPLIT_START, TRAIN_D, DELAY_D, TEST_D)
    cols = [S.TX_ID, S.TX_AMOUNT, S.TX_FRAUD, S.TX_FRAUD_SCENARIO, *TERM]
    return _amount_as_double(train.select(F.lit("train").alias("part"), *cols)
                             .unionByName(test.select(F.lit("test").alias("part"), *cols)))


@register("store_transactions", f"""WITH {Q.TX}
SELECT TRANSACTION_ID, TX_DATETIME, TX_US, CUSTOMER_ID, TERMINAL_ID, CAST(TX_AMOUNT AS DOUBLE) AS TX_AMOUNT,
       TX_TIME_SECONDS, TX_TIME_DAYS, TX_FRAUD FROM tx""")
def store_transactions(spark, sf):
    """Written by day and read back."""
    path = scratch_path(spark, f"transactions-{uuid.uuid4().hex}")
    write_transactions(_tx(spark, sf), path)
    return _amount_as_double(read_transactions(spark, path))


@register("store_snapshots", f"""WITH {Q.TX}, {Q.FEAT}, {_SNAPS}
SELECT 'customer' AS kind, CUSTOMER_ID AS id, {CUST[0]} AS first_count FROM snc
UNION ALL SELECT 'terminal' AS kind, TERMINAL_ID AS id, {TERM[0]} AS first_count FROM snt""")
def store_snapshots(spark, sf):
    """Both snapshots saved as tables bucketed by key, and loaded."""
    snc, snt = _frozen_snapshots(spark, sf)
    path = scratch_path(spark, f"snapshots-{uuid.uuid4().hex}")
    SV.save_snapshots(path, snc, snt, buckets=4)
    snc, snt = SV.load_snapshots(spark, path)
    return snc.select(F.lit("customer").alias("kind"), F.col(S.CUSTOMER_ID).alias("id"), F.col(CUST[0]).alias("first_count")).unionByName(
        snt.select(F.lit("terminal").alias("kind"), F.col(S.TERMINAL_ID).alias("id"), F.col(TERM[0]).alias("first_count")))


@register("store_replies", f"""WITH {Q.TX}
SELECT TRANSACTION_ID, CAST(TX_AMOUNT AS DOUBLE) / 1000 AS prob_fraud FROM tx WHERE TX_TIME_DAYS >= {SERVE_DAY}""")
def store_replies(spark, sf):
    """JSON reply records of a stated score, written and read back."""
    path = scratch_path(spark, f"replies-{uuid.uuid4().hex}")
    scored = _tx(spark, sf).where(F.col(S.TX_TIME_DAYS) >= SERVE_DAY).select(
        S.TX_ID, (F.col(S.TX_AMOUNT).cast("double") / 1000).alias("prob_fraud"))
    RQ.write_replies(scored, path)
    return spark.read.schema(f"{S.TX_ID} bigint, prob_fraud double").json(path)


@register("rule_counts", f"""WITH {Q.TX}, {_IVALS}
SELECT CAST(CASE WHEN r1 THEN 1 WHEN r2 THEN 2 ELSE 3 END AS BIGINT) AS rule, count(*) AS n_new_frauds
FROM lab WHERE r1 OR r2 OR k > 0 GROUP BY 1""")
def rule_counts_q(spark, sf):
    return LB.rule_counts(_labelled(spark, sf))


_PTS = """cp AS (SELECT CUSTOMER_ID, CAST((CUSTOMER_ID * 37) % 1000 AS DOUBLE) / 10.0 AS x_customer_id,
                   CAST((CUSTOMER_ID * 91) % 1000 AS DOUBLE) / 10.0 AS y_customer_id
            FROM (SELECT DISTINCT CUSTOMER_ID FROM tx WHERE CUSTOMER_ID IS NOT NULL) c),
tp AS (SELECT TERMINAL_ID, CAST((TERMINAL_ID * 53) % 1000 AS DOUBLE) / 10.0 AS x_terminal_id,
              CAST((TERMINAL_ID * 29) % 1000 AS DOUBLE) / 10.0 AS y_terminal_id
       FROM (SELECT DISTINCT TERMINAL_ID FROM tx WHERE TERMINAL_ID IS NOT NULL) t),
pr AS (SELECT CUSTOMER_ID, TERMINAL_ID,
         sqrt((x_customer_id - x_terminal_id) * (x_customer_id - x_terminal_id)
              + (y_customer_id - y_terminal_id) * (y_customer_id - y_terminal_id)) AS distance
       FROM cp, tp)"""


@register("radius_join", f"""WITH {Q.TX}, {_PTS}
SELECT * FROM pr WHERE distance < 5.0""")
def radius_join_q(spark, sf):
    tx = _tx(spark, sf)
    return SPA.radius_join(SPA.customer_points(tx), SPA.terminal_points(tx))


@register("customer_terminals", f"""WITH {Q.TX}, {_PTS}
SELECT cp.*, coalesce(string_agg(CAST(pr.TERMINAL_ID AS VARCHAR), ',' ORDER BY pr.TERMINAL_ID), '') AS available_terminals,
       count(pr.TERMINAL_ID) AS nb_terminals
FROM cp LEFT JOIN (SELECT * FROM pr WHERE distance < 5.0) pr USING (CUSTOMER_ID)
GROUP BY cp.CUSTOMER_ID, cp.x_customer_id, cp.y_customer_id""")
def customer_terminals(spark, sf):
    tx = _tx(spark, sf)
    out = SPA.terminals_within_radius(SPA.customer_points(tx), SPA.terminal_points(tx))
    as_text = F.array_join(F.transform("available_terminals", lambda x: x.cast("string")), ",")
    return out.select(S.CUSTOMER_ID, "x_customer_id", "y_customer_id", as_text.alias("available_terminals"),
                      "nb_terminals")


@register("chronological_id", f"""WITH {Q.TX}
SELECT TRANSACTION_ID, row_number() OVER (ORDER BY TX_US, CUSTOMER_ID, TERMINAL_ID, TRANSACTION_ID) - 1 AS CHRONO_ID
FROM tx""")
def chronological_id_q(spark, sf):
    return chronological_id(_tx(spark, sf).select(S.TX_ID, S.TX_US, S.CUSTOMER_ID, S.TERMINAL_ID)) \
        .select(S.TX_ID, "CHRONO_ID")


@register("time_offsets", f"""WITH {Q.TX}
SELECT TRANSACTION_ID, TX_TIME_SECONDS, TX_TIME_DAYS,
       TIMESTAMP '{EVENTS_ORIGIN} 00:00:00' + to_seconds(TX_TIME_SECONDS) AS TX_DATETIME_FROM_SECONDS FROM tx""")
def time_offsets(spark, sf):
    tx = _tx(spark, sf)
    return tx.select(S.TX_ID, S.TX_TIME_SECONDS, S.TX_TIME_DAYS,
                     TF.from_offset_seconds(S.TX_TIME_SECONDS, EVENTS_ORIGIN).alias("TX_DATETIME_FROM_SECONDS"))


# ---------------------------------------------------------------- step 7 ---
from pyspark.ml.functions import vector_to_array  # noqa: E402

from ..ml import pipeline as MLP  # noqa: E402
from ..ml import frame as MF, logit as LG, trees as MT, tuning as TU  # noqa: E402
from ..plans import training as TR  # noqa: E402
from ..session import write_scratch  # noqa: E402

_FSPLIT = Q.split_ctes(SPLIT_START, TRAIN_D, DELAY_D, TEST_D, src="feat")
_R6 = 6


def _feat_split(spark, sf, persist=False):
    return TR.train_test_features(_tx(spark, sf), SPLIT_START, TRAIN_D, DELAY_D, TEST_D, persist=persist)


def _thr_sql(src):
    return f"""(SELECT n, tp, fp, tn, fn,
  CAST(tp + tn AS DOUBLE) / n AS acc,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1_score,
  sqrt((CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END)
     * (CASE WHEN tn + fp = 0 THEN 0.0 ELSE CAST(tn AS DOUBLE) / (tn + fp) END)) AS gmean
FROM (SELECT count(*) AS n,
        count(*) FILTER (WHERE score > 0.5 AND TX_FRAUD = 1) AS tp,
        count(*) FILTER (WHERE score > 0.5 AND TX_FRAUD <> 1) AS fp,
        count(*) FILTER (WHERE NOT score > 0.5 AND TX_FRAUD <> 1) AS tn,
        count(*) FILTER (WHERE NOT score > 0.5 AND TX_FRAUD = 1) AS fn FROM {src}) c)"""


@register("dummy_metrics", f"""WITH {Q.TX}, {Q.FEAT}, {_FSPLIT},
dsc AS (SELECT *, (SELECT avg(CAST(TX_FRAUD AS DOUBLE)) FROM trn) AS score FROM tst)
SELECT 'dummy' AS clf, round(t.acc, {R9}) AS acc, round(t.f1_score, {R9}) AS f1_score, round(t.gmean, {R9}) AS gmean,
       round(r.auc, {R9}) AS auc, round(r.average_precision, {R9}) AS average_precision
FROM {_thr_sql("dsc")} t, ({Q.ranking_sql("dsc", digits=None)}) r""")
def dummy_metrics(spark, sf):
    train, test = _feat_split(spark, sf)
    m = TR.evaluate(TR.dummy_scored(train, test), "dummy")
    return m.select("clf", *_r(TR.METRIC_COLS))


_IN = S.INPUT_FEATURES


@register("impute_mean", f"""WITH {Q.TX}, {Q.FEAT}, {_FSPLIT}, {_REQ}, {_SNAPS},
enr AS (SELECT reqf.*, {", ".join("snc." + c for c in CUST)}, {", ".join("snt." + c for c in TERM)}
        FROM reqf LEFT JOIN snc USING (CUSTOMER_ID) LEFT JOIN snt USING (TERMINAL_ID))
SELECT TRANSACTION_ID, {", ".join(f"round(coalesce(CAST({c} AS DOUBLE), (SELECT avg(CAST({c} AS DOUBLE)) FROM trn)), {R9}) AS {c}" for c in _IN)}
FROM enr""")
def impute_mean(spark, sf):
    """M1: means learned on the train split fill the nulls of enriched requests
    (unknown customers / terminals)."""
    from pyspark.ml.feature import Imputer
    train, _ = _feat_split(spark, sf)
    req = enrich_full(spark, sf)
    imp = Imputer(strategy="mean", inputCols=_IN, outputCols=[f"__i_{c}" for c in _IN])
    model = imp.fit(MLP.prepare(train, _IN))
    out = model.transform(MLP.prepare(req.withColumn(S.TX_FRAUD, F.lit(0)), _IN))
    return out.select(S.TX_ID, *[F.round(f"__i_{c}", R9).alias(c) for c in _IN])


@register("standardize", f"""WITH {Q.TX}, {Q.FEAT}, {_FSPLIT},
st AS (SELECT {", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}" for c in _IN)} FROM trn)
SELECT TRANSACTION_ID, {", ".join(f"round(CASE WHEN s_{c} = 0 THEN 0.0 ELSE (CAST({c} AS DOUBLE) - m_{c}) / s_{c} END, {_R6}) AS {c}" for c in _IN)}
FROM tst, st""")
def standardize(spark, sf):
    """M2: population standardisation learned on train, applied to test."""
    train, test = _feat_split(spark, sf, persist=True)
    cols, _, pre = MLP.fit_preprocessing(train, _IN)
    arr = vector_to_array(F.col("features"))
    out = pre.transform(MLP.prepare(test, cols))
    return out.select(S.TX_ID, *[F.round(arr[i], _R6).alias(c) for i, c in enumerate(cols)])


def _fit_key(kind, name, **params):
    def fn(spark, sf):
        train, test = _feat_split(spark, sf, persist=True)
        return TR.fit_and_evaluate(train, test, name, kind, **params)
    return fn


for _name, (_kind, _params) in TR.DEFAULT_MODELS.items():
    QUERIES[{"knn": "fit_knn", "logistic": "fit_logistic", "tree": "fit_tree", "bagging": "fit_bagging",
             "rf": "fit_forest",
             "GradientBoost": "fit_gbt"}[_name]] = _fit_key(_kind, _name, **_params)


def _input_rows(spark, sf):
    train, _ = _feat_split(spark, sf, persist=True)
    scaling = MF.fit_scaling(train)
    return scaling, write_scratch(MF.inputs(train, scaling), "fit-rows")


_SLOPES_SQL = f"""SELECT name, 0.0::DOUBLE AS largest FROM (VALUES {", ".join(f"('{c}')" for c in [*_IN, "intercept"])}) v(name)"""


def _loss_slopes(rows, w):
    """Mean slope of the log loss in each weight and the intercept, as column expressions over (x, y)."""
    z = F.lit(float(w[-1]))
    for i, v in enumerate(w[:-1]):
        z = z + F.lit(float(v)) * F.col(MF.X)[i]
    miss = F.lit(1.0) / (F.lit(1.0) + F.exp(-z)) - F.col(MF.Y)
    return [F.avg(miss * F.col(MF.X)[i]) for i in range(len(w) - 1)] + [F.avg(miss)]


def _named(aggregated, names):
    return aggregated.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.round(F.col(c), 6).alias("largest")) for c in names])))


@register("logistic_gradient", _SLOPES_SQL)
def logistic_gradient(spark, sf):
    """M6 by its own optimality condition: the penalised mean log-loss has no slope left
    at the fitted coefficients (absolute partial derivatives, to six digits)."""
    scaling, rows = _input_rows(spark, sf)
    n = scaling.n[0]
    w = LG.fit_logits(rows, [LG.Logit("m6", 0, "l2", 0.5)], len(_IN), scaling.n).popitem()[1]
    names = [*_IN, "intercept"]
    shrink = [v / (0.5 * n) for v in w[:-1]] + [0.0]
    return _named(rows.agg(*[F.abs(s + F.lit(float(p))).alias(c) for c, s, p in zip(names, _loss_slopes(rows, w), shrink)]), names)


@register("logistic_l1_conditions", _SLOPES_SQL)
def logistic_l1_conditions(spark, sf):
    """M7 by the optimality (KKT) conditions of the L1 penalty, intercept included: a weight that is not 0
    has the loss slope -sign(w) / (C n), and one that is 0 a slope within +-1 / (C n).  Distances from
    that, to six digits, for both C of the grid together (the larger one)."""
    scaling, rows = _input_rows(spark, sf)
    n, names = scaling.n[0], [*_IN, "intercept"]
    fits = LG.fit_logits(rows, [LG.Logit("m7", 0, "l1", c, penalised_intercept=True) for c in (0.5, 5.0)], len(_IN), scaling.n)
    miss = []
    for spec, w in fits.items():
        edge = 1 / (spec.C * n)
        miss.append([F.abs(s + F.lit(edge if v > 0 else -edge)) if v else F.greatest(F.abs(s) - F.lit(edge), F.lit(0.0))
                     for s, v in zip(_loss_slopes(rows, w), w.tolist())])
    return _named(rows.agg(*[F.greatest(a, b).alias(c) for c, a, b in zip(names, *miss)]), names)


def _leaves_sql(members):
    return f"""WITH {Q.TX}, {Q.FEAT}, {_FSPLIT}
SELECT m.member::INT AS member, count(*) AS n_rows, CAST(sum(TX_FRAUD) AS BIGINT) AS n_frauds, 0.0::DOUBLE AS lost_weight, 0.0::DOUBLE AS largest_gap
FROM trn, (SELECT unnest(range({members})) AS member) m GROUP BY m.member"""


def _leaves_key(name, kind, params, members):
    """Per tree: the train rows routed through its relation by their values.  ``lost_weight``: bootstrap weight
    drawn that its leaves do not hold; ``largest_gap``: a leaf's share of frauds against what it says."""
    def fn(spark, sf):
        scaling, rows = _input_rows(spark, sf)
        spec = TU.specs_of(name, kind, params, 0, len(_IN))[0]
        edges = MT.bin_edges(rows, len(_IN))
        nodes = MT.fit_forests(MT.binned(rows, edges), [spec], edges, scaling.n)
        held = MT.leaf_totals(rows, MT.ensemble(nodes), spec).alias("h")
        leaf = nodes.where("input < 0").select("member", "node", "weight", "value").alias("l")
        gaps = (leaf.join(held, ["member", "node"], "full").groupBy("member").agg(
            F.round(F.sum(F.abs(F.coalesce("l.weight", F.lit(0.0)) - F.coalesce("h.weight", F.lit(0.0)))), R9).alias("lost_weight"),
            F.round(F.max(F.abs(F.col("value") - F.col("positive") / F.col("h.weight"))), R9).alias("largest_gap")))
        total = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(MF.Y), F.lit(0)).cast("bigint").alias("n_frauds")).first()
        return gaps.select("member", *[F.lit(total[c]).cast("bigint").alias(c) for c in ("n_rows", "n_frauds")], "lost_weight", "largest_gap")
    return register(name, _leaves_sql(members))(fn)


_leaves_key("tree_leaves", "tree", {}, 1)
_leaves_key("bagging_leaves", "bagging", {"n_estimators": 10}, 10)
_leaves_key("forest_leaves", "forest", {"n_estimators": 100}, 100)
_leaves_key("bagging_half_leaves", "bagging_ensemble", {"base": "tree", "max_features": 0.5, "n_members": 200, "random_state": 10}, 200)


@register("leaderboard")
def leaderboard_q(spark, sf):
    train, test = _feat_split(spark, sf, persist=True)
    return TR.leaderboard(train, test)


# --------------------------------------------------------------- step 10 ---
import uuid  # noqa: E402

from ..plans import serving as SV  # noqa: E402
from ..session import scratch_path  # noqa: E402
from ..ml.linear import LinearScorer  # noqa: E402
from ..streaming.scoring import start_scoring  # noqa: E402

# the configuration the workload deploys: logistic regression, L2, C = 0.5
SERVE_MODEL = ("logistic", {"penalty": "l2", "C": 0.5})


def _serving_artifacts(spark, sf, tx, buckets=None):
    """Fit on the split's train rows, freeze snapshots before SERVE_DAY, and
    round-trip everything through the shared scratch folder (S5/S6)."""
    train, _ = TR.train_test_features(tx, SPLIT_START, TRAIN_D, DELAY_D, TEST_D)
    model = TU.fit_config(train, *SERVE_MODEL)
    snc, snt = _frozen_snapshots(spark, sf, tx)
    path = scratch_path(spark, f"artifacts-{uuid.uuid4().hex}")
    SV.save_artifacts(path, model, snc, snt, buckets=buckets)
    return SV.load_artifacts(spark, path)


@register("score_batch")
def score_batch(spark, sf):
    tx = _written_tx(spark, sf)
    model, snc, snt = _serving_artifacts(spark, sf, tx)
    lines = RQ.requests_from_transactions(tx.where(F.col(S.TX_TIME_DAYS) >= SERVE_DAY))
    return SV.score_requests(RQ.parse_request_lines(lines), snc, snt, model)


# fixed values: a stated linear score, so that SQL can follow the serving paths
LINEAR = (-4.0, {S.TX_AMOUNT: 0.004, S.NIGHT: 0.1, CUST[3]: -0.002, TERM[3]: 2.0, TERM[2]: 0.01})
_LINEAR_SQL = " + ".join([f"{LINEAR[0]}::DOUBLE"] + [f"{w}::DOUBLE * coalesce(CAST({c} AS DOUBLE), 0.0)" for c, w in LINEAR[1].items()])
_SCORED_SQL = f"""WITH {Q.TX}, {Q.FEAT}, {_REQ}, {_SNAPS},
enr AS (SELECT reqf.*, {", ".join("snc." + c for c in CUST)}, {", ".join("snt." + c for c in TERM)}
        FROM reqf LEFT JOIN snc USING (CUSTOMER_ID) LEFT JOIN snt USING (TERMINAL_ID))
SELECT TRANSACTION_ID, round(1.0 / (1.0 + exp(-({_LINEAR_SQL}))), {R9}) AS prob_fraud FROM enr"""


@register("score_batch_linear", _SCORED_SQL)
def score_batch_linear(spark, sf):
    tx = _written_tx(spark, sf)
    lines = RQ.requests_from_transactions(tx.where(F.col(S.TX_TIME_DAYS) >= SERVE_DAY))
    scored = SV.score_requests(RQ.parse_request_lines(lines), *_frozen_snapshots(spark, sf, tx), LinearScorer(*LINEAR))
    return scored.select(S.TX_ID, F.round(MLP.PROB, R9).alias(MLP.PROB))


@register("score_stream_linear", _SCORED_SQL)
def score_stream_linear(spark, sf):
    """The same requests through the streaming query."""
    tx = _written_tx(spark, sf)
    run = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    RQ.requests_from_transactions(tx.where(F.col(S.TX_TIME_DAYS) >= SERVE_DAY)).write.text(f"{run}/requests")
    start_scoring(spark, f"{run}/requests", LinearScorer(*LINEAR), *_frozen_snapshots(spark, sf, tx),
                  f"{run}/replies", f"{run}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{run}/replies").select(S.TX_ID, F.round(MLP.PROB, R9).alias(MLP.PROB))


@register("score_stream")
def score_stream(spark, sf):
    """Same replies as ``score_batch``, produced by a streaming query over
    request files written from the data (availableNow trigger)."""
    tx = _written_tx(spark, sf)
    # snapshots stored bucketed by key: micro-batches shuffle only the requests
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    model, snc, snt = _serving_artifacts(spark, sf, tx, buckets=buckets)
    run = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    RQ.requests_from_transactions(tx.where(F.col(S.TX_TIME_DAYS) >= SERVE_DAY)) \
        .write.mode("overwrite").text(f"{run}/requests")
    q = start_scoring(spark, f"{run}/requests", model, snc, snt, f"{run}/replies", f"{run}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{run}/replies")


# ---------------------------------------------------------------- step 9 ---
def _grid_scores(spark, sf):
    feat = _fold_feat(spark, sf)
    folds = SP.cv_folds(feat, CV_START, N_FOLDS, TRAIN_D, DELAY_D, TEST_D)
    return TU.grid_search(folds)


@register("grid_search")
def grid_search_q(spark, sf):
    return _grid_scores(spark, sf)


@register("final_report")
def final_report_q(spark, sf):
    scores = _grid_scores(spark, sf)
    train, test = _feat_split(spark, sf, persist=True)
    return TU.final_report(scores, train, test)


# ---------------------------------------------------------------- step 7b --
from ..ml.knn import knn_scores  # noqa: E402

KNN_K = 5  # fixed value: the workload's neighbour count


def _z(c, alias):
    return f"CASE WHEN s_{c} = 0 THEN 0.0 ELSE (CAST({c} AS DOUBLE) - m_{c}) / s_{c} END AS {alias}"


@register("knn_score", f"""WITH {Q.TX}, {Q.FEAT}, {_FSPLIT},
st AS (SELECT {", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}" for c in _IN)} FROM trn),
ztr AS (SELECT TRANSACTION_ID AS tid, CAST(TX_FRAUD AS DOUBLE) AS y, {", ".join(_z(c, f"z{i}") for i, c in enumerate(_IN))} FROM trn, st),
zte AS (SELECT TRANSACTION_ID AS qid, {", ".join(_z(c, f"z{i}") for i, c in enumerate(_IN))} FROM tst, st),
d AS (SELECT qid, tid, y, {" + ".join(f"(zte.z{i} - ztr.z{i}) * (zte.z{i} - ztr.z{i})" for i in range(len(_IN)))} AS d2
      FROM zte, ztr),
r AS (SELECT qid, y, row_number() OVER (PARTITION BY qid ORDER BY d2, tid) AS rn FROM d)
SELECT qid AS TRANSACTION_ID, avg(y) AS prob_fraud FROM r WHERE rn <= {KNN_K} GROUP BY qid""")
def knn_score(spark, sf):
    train, test = _feat_split(spark, sf, persist=True)
    return knn_scores(train, test.select(S.TX_ID, *_IN), k=KNN_K).select(S.TX_ID, MLP.PROB)


_KNN_SQL = ORACLE_SQL["knn_score"]


@register("fit_knn", f"""WITH {Q.TX}, {Q.FEAT}, {_FSPLIT},
ksc AS (SELECT k.prob_fraud AS score, tst.TX_FRAUD FROM ({_KNN_SQL}) k JOIN tst ON tst.TRANSACTION_ID = k.TRANSACTION_ID)
SELECT 'knn' AS clf, round(t.acc, {R9}) AS acc, round(t.f1_score, {R9}) AS f1_score, round(t.gmean, {R9}) AS gmean,
       round(r.auc, {R9}) AS auc, round(r.average_precision, {R9}) AS average_precision
FROM {_thr_sql("ksc")} t, ({Q.ranking_sql("ksc", digits=None)}) r""")
def fit_knn(spark, sf):
    train, test = _feat_split(spark, sf, persist=True)
    return TR.fit_and_evaluate(train, test, "knn", "knn", k=KNN_K).select("clf", *_r(TR.METRIC_COLS))


@register("final_report_top_k")
def final_report_top_k(spark, sf):
    """The second selection of the workload: the same grid scored by the daily
    precision of the top-k alerts, one-SD choice, refit, test precision."""
    feat = _fold_feat(spark, sf)
    folds = SP.cv_folds(feat, CV_START, N_FOLDS, TRAIN_D, DELAY_D, TEST_D)
    scorer = TU.scorer_precision_top_k(S.TOP_K)
    scores = TU.grid_search(folds, scorer=scorer)
    train, test = _feat_split(spark, sf, persist=True)
    return TU.final_report(scores, train, test, scorer=scorer)

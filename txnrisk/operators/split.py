"""Time splits with a label-delay gap.

Reference semantics, restated as set logic:

* train = rows with ``start <= TX_DATETIME < start + train days``;
  ``s`` = the smallest TX_TIME_DAYS among them (data dependent).
* test days are ``D = s + train + delay + k`` for ``k < test``.
* a customer is dropped from test day D when it has a fraud in train, or a
  fraud on a day f with ``s + train - 1 <= f <= D - delay - 1`` (the frauds
  that became known before D).  With ``known_day`` = min(s for train frauds,
  f for the others) this is ``known_day <= D - delay - 1``: one aggregate and
  one anti-join, no per-day loop.

``s`` is read with one tiny job so that the day predicates reach the scan as
literals (partition pruning on day-partitioned tables).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, functions as F

from .. import schema as S
from ..functions.time import ntz_literal

KNOWN_DAY = "KNOWN_DAY"


def _ts(start) -> Column:
    if isinstance(start, str):
        start = _dt.datetime.fromisoformat(start)
    elif isinstance(start, _dt.date) and not isinstance(start, _dt.datetime):
        start = _dt.datetime(start.year, start.month, start.day)
    return ntz_literal(start)


def _as_dt(start) -> _dt.datetime:
    if isinstance(start, str):
        return _dt.datetime.fromisoformat(start)
    if isinstance(start, _dt.datetime):
        return start
    return _dt.datetime(start.year, start.month, start.day)


def day_range(d0: int, d1: int, origin=None) -> Column:
    """TX_TIME_DAYS in [d0, d1].  With ``origin`` (the day-0 date) the same
    range is also stated on TX_DATETIME, a plain column predicate the Parquet
    scan can push down to row-group statistics (TX_TIME_DAYS may be computed)."""
    pred = F.col(S.TX_TIME_DAYS).between(d0, d1)
    if origin is not None:
        o = _as_dt(origin)
        lo, hi = o + _dt.timedelta(days=d0), o + _dt.timedelta(days=d1 + 1)
        pred = pred & (F.col(S.TX_DATETIME) >= _ts(lo)) & (F.col(S.TX_DATETIME) < _ts(hi))
    return pred


def train_window(tx: DataFrame, start, delta_train: int = 7) -> DataFrame:
    """Rows with start <= TX_DATETIME < start + delta_train days."""
    st = _as_dt(start)
    end = st + _dt.timedelta(days=delta_train)
    return tx.where((F.col(S.TX_DATETIME) >= _ts(st)) & (F.col(S.TX_DATETIME) < _ts(end)))


def first_train_day(train: DataFrame):
    """s = min(TX_TIME_DAYS) of the train rows, or None when train is empty."""
    return train.agg(F.min(S.TX_TIME_DAYS)).first()[0]


def known_customers(tx: DataFrame, train: DataFrame, s: int, delta_train: int, delta_test: int,
                    origin=None) -> DataFrame:
    """(CUSTOMER_ID, KNOWN_DAY): first day a customer counts as known-defrauded."""
    from_train = train.where(F.col(S.TX_FRAUD) == 1).select(S.CUSTOMER_ID, F.lit(s).cast("bigint").alias(KNOWN_DAY))
    later = (tx.where((F.col(S.TX_FRAUD) == 1)
                      & day_range(s + delta_train - 1, s + delta_train + delta_test - 2, origin))
               .select(S.CUSTOMER_ID, F.col(S.TX_TIME_DAYS).alias(KNOWN_DAY)))
    return from_train.unionByName(later).groupBy(S.CUSTOMER_ID).agg(F.min(KNOWN_DAY).alias(KNOWN_DAY))


def exclude_known(test_days: DataFrame, known: DataFrame, delta_delay: int) -> DataFrame:
    """Drop test rows whose customer was known before the row's day.

    An equi anti-join on customer with a day residual; AQE broadcasts the
    known set when its measured size allows, else shuffles both sides.
    """
    k = known.withColumnRenamed(S.CUSTOMER_ID, "__kc")
    cond = (F.col(S.CUSTOMER_ID) == F.col("__kc")) & \
        (F.col(KNOWN_DAY) <= F.col(S.TX_TIME_DAYS) - F.lit(delta_delay + 1))
    return test_days.join(k, cond, "left_anti")


def delayed_split(tx: DataFrame, start, delta_train: int = 7, delta_delay: int = 7,
                  delta_test: int = 7, origin=None) -> tuple[DataFrame, DataFrame]:
    """(train, test) DataFrames of the delayed split.  ``origin`` (the date
    of day 0) is optional and only adds pushable time predicates."""
    train = train_window(tx, start, delta_train)
    s = first_train_day(train)
    if s is None:  # empty train set gives an empty test set
        return train, tx.limit(0)
    d0 = s + delta_train + delta_delay
    test_days = tx.where(day_range(d0, d0 + delta_test - 1, origin))
    known = known_customers(tx, train, s, delta_train, delta_test, origin)
    return train, exclude_known(test_days, known, delta_delay)


# ----------------------------------------------------------------- folds ---

FOLD = "fold"
ROLE = "role"


def _fold_starts(start, n_folds: int, delta_val: int) -> list[_dt.datetime]:
    st = _as_dt(start)
    return [st - _dt.timedelta(days=i * delta_val) for i in range(n_folds)]


def cv_folds(tx: DataFrame, start, n_folds: int = 5, delta_train: int = 7, delta_delay: int = 7,
             delta_val: int = 7) -> DataFrame:
    """Sequential folds as a relation (fold, role, <tx columns>).

    Fold i trains from ``start - i * delta_val`` days.  Each row is tagged with
    the folds it belongs to by arithmetic on its own time (an explode of at
    most n_folds tags), never by joining a folds table to every row.
    """
    starts = _fold_starts(start, n_folds, delta_val)
    ts = F.col(S.TX_DATETIME)
    # all folds together, as literals that reach the scan
    span = _dt.timedelta(days=2 * delta_train + delta_delay + delta_val + 1)
    tx = tx.where((ts >= _ts(min(starts))) & (ts < _ts(max(starts) + span)))
    # train membership per fold: literal bounds, one boolean per fold
    train_tags = F.array(*[F.when((ts >= _ts(st)) & (ts < _ts(st + _dt.timedelta(days=delta_train))), F.lit(i))
                           for i, st in enumerate(starts)])
    train = (tx.select("*", F.explode(F.filter(train_tags, lambda x: x.isNotNull())).alias(FOLD)))
    # s_i per fold: <= n_folds rows reach the driver
    s_by_fold = {r[FOLD]: r["s"] for r in train.groupBy(FOLD).agg(F.min(S.TX_TIME_DAYS).alias("s")).collect()}
    folds = sorted(s_by_fold)
    train_rel = train.select(F.col(FOLD).cast("bigint").alias(FOLD), F.lit("train").alias(ROLE), *tx.columns)
    if not folds:
        return train_rel
    day = F.col(S.TX_TIME_DAYS)
    # validation days per fold, then the known customers per fold
    val_tags = F.array(*[F.when(day.between(s_by_fold[i] + delta_train + delta_delay,
                                            s_by_fold[i] + delta_train + delta_delay + delta_val - 1), F.lit(i))
                         for i in folds])
    val_days = tx.select("*", F.explode(F.filter(val_tags, lambda x: x.isNotNull())).alias(FOLD))
    late_tags = F.array(*[F.when(day.between(s_by_fold[i] + delta_train - 1, s_by_fold[i] + delta_train + delta_val - 2),
                                 F.struct(F.lit(i).alias(FOLD), day.alias(KNOWN_DAY)))
                          for i in folds])
    frauds = tx.where(F.col(S.TX_FRAUD) == 1)
    late = frauds.select(S.CUSTOMER_ID, F.inline(F.filter(late_tags, lambda x: x.isNotNull())))
    early = train.where(F.col(S.TX_FRAUD) == 1).select(
        S.CUSTOMER_ID, F.col(FOLD),
        F.element_at(F.create_map(*[x for i in folds for x in (F.lit(i), F.lit(s_by_fold[i]))]),
                     F.col(FOLD)).cast("bigint").alias(KNOWN_DAY))
    known = (early.unionByName(late.select(S.CUSTOMER_ID, FOLD, KNOWN_DAY))
             .groupBy(FOLD, S.CUSTOMER_ID).agg(F.min(KNOWN_DAY).alias(KNOWN_DAY))
             .withColumnRenamed(S.CUSTOMER_ID, "__kc").withColumnRenamed(FOLD, "__kf"))
    cond = ((F.col(FOLD) == F.col("__kf")) & (F.col(S.CUSTOMER_ID) == F.col("__kc"))
            & (F.col(KNOWN_DAY) <= day - F.lit(delta_delay + 1)))
    val = val_days.join(known, cond, "left_anti")
    val_rel = val.select(F.col(FOLD).cast("bigint").alias(FOLD), F.lit("val").alias(ROLE), *tx.columns)
    return train_rel.unionByName(val_rel)

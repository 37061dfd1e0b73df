"""The feature table (transactions + calendar flags + customer and terminal windows).

Physical shape: one shuffle keyed by customer and one keyed by terminal (native
RANGE frames for ordinary keys; time-bucketed event sums for hot keys, which
then shuffle on (key, bucket)); everything else is narrow.  Hot keys are found
by small aggregates over (key, time) of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schema as S
from ..functions.time import ntz_literal
from ..operators.calendar import add_calendar_flags
from ..operators.hotkeys import HOT_KEY_ROWS, hot_keys
from ..operators.rolling import customer_spending_windows, delayed_risk_windows


def feature_table(tx: DataFrame, windows=S.WINDOWS_DAYS, delay: int = S.DELAY_DAYS,
                  strategy: str = "auto", bucket_us: int = S.DAY_US,
                  hot_rows: int | None = None) -> DataFrame:
    hot_rows = HOT_KEY_ROWS if hot_rows is None else hot_rows
    hot_c = hot_t = None
    if strategy == "auto":
        # from small aggregates over (key, time) of the input; terminal windows
        # only see rows that have a customer
        base = tx.where(F.col(S.CUSTOMER_ID).isNotNull())
        hot_c = hot_keys(base, S.CUSTOMER_ID, S.TX_US, hot_rows)
        hot_t = hot_keys(base, S.TERMINAL_ID, S.TX_US, hot_rows)
    df = add_calendar_flags(tx)
    df = customer_spending_windows(df, windows, S.CUSTOMER_ID, strategy, bucket_us, hot_rows, hot_c)
    df = delayed_risk_windows(df, delay, windows, S.TERMINAL_ID, strategy, bucket_us, hot_rows, hot_t)
    return df


def feature_table_between(tx: DataFrame, t_from, t_to, windows=S.WINDOWS_DAYS, delay: int = S.DELAY_DAYS,
                          **kw) -> DataFrame:
    """Feature rows with t_from <= TX_DATETIME < t_to, computed from the input
    sliced to [t_from - (delay + max window) days, t_to).

    Every frame of a kept row lies inside the slice, so its values equal the
    full-history ones; rows of the look-back margin (truncated history) are
    dropped.  The time predicates reach the Parquet scan, so a job on a few
    weeks of a multi-year table reads only those weeks."""
    lo = look_back(t_from, windows, delay)
    sliced = tx.where((F.col(S.TX_DATETIME) >= ntz_literal(lo)) & (F.col(S.TX_DATETIME) < ntz_literal(_ts(t_to))))
    feat = feature_table(sliced, windows, delay, **kw)
    return feat.where(F.col(S.TX_DATETIME) >= ntz_literal(_ts(t_from)))


def look_back(t_from, windows=S.WINDOWS_DAYS, delay: int = S.DELAY_DAYS):
    """The earliest time that a window of a row at ``t_from`` reaches."""
    import datetime as dt
    return _ts(t_from) - dt.timedelta(days=delay + max(windows))


def _ts(x):
    import datetime as dt
    if isinstance(x, str):
        return dt.datetime.fromisoformat(x)
    if isinstance(x, dt.datetime):
        return x
    return dt.datetime(x.year, x.month, x.day)

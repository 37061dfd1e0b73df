"""Trailing per-key windows.

Frames are half-open on the left, in microseconds:

* customer spending, window N:  (t - N days, t]            current row included
* delayed key risk, delay d:    (t - (d+N) days, t - d days]

Rows with equal timestamps are peers: each sees all of them (RANGE frame).

Three strategies compute the same numbers:

``"events"`` (skew-safe)
    Every row emits a +measure event when it enters the frame of later rows
    and a -measure event when it leaves it (one per window size).  A window
    value is then a running sum of events up to the row's own time.  The
    running sum is bucketed in time (see :mod:`.prefix`; a day, or a per-key
    width in ``auto``), so a key holding a third of all rows is spread over
    many tasks.

``"frame"``
    Spark's own RANGE frames over ``partitionBy(key)``: one shuffle, one sort,
    best when no key is hot.  A window is the difference of two running totals,
    so the cost does not grow with the rows in a frame.

``"auto"`` (default)
    One map-side-combined count per key finds the keys with too many rows for
    one task.  They take ``"events"``, cut by quantiles of their own times;
    the others use ``"frame"``.  The two are joined to the rows by key, so no
    list of keys reaches the driver.  No hot key: plain ``"frame"``.

Rows without a time have no window (count 0, mean null, risk 0) and are in none;
a window without amounts has a null mean.  All strategies agree on this.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import schema as S
from ..functions.numeric import safe_ratio
from .hotkeys import EDGES, FIND, HOT_KEY_ROWS, hot_keys, time_slice
from .prefix import bucketed_running_sum

_PAYLOAD = "__payload"
_KIND = "__kind"
_EVT = "__ev_t"


def _event_running_sums(df: DataFrame, key: str, lo_us: int, hi_us: list[int],
                        measures: dict[str, Column], bucket_us) -> DataFrame:
    """Sums of ``measures`` over rows j of the same key with t - hi < t_j <= t - lo,
    one result per (hi, measure) named ``{measure}@{i}`` (i = index in hi_us)."""
    names = list(measures)
    timed = F.col(S.TX_US).isNotNull()
    edges = [EDGES] if bucket_us is None else []      # slices: the key's own edges, or a fixed width
    base = df.select(F.col(key), F.col(S.TX_US), *edges,
                     *[F.when(timed, m).otherwise(F.lit(0)).alias(f"__v_{n}") for n, m in measures.items()],
                     F.struct(*[F.col(c) for c in df.columns if c not in edges]).alias(_PAYLOAD))
    # kind 0 = the row itself (a query; also the 'enter' event when lo = 0),
    # kind 1 = delayed 'enter' event at t + lo, kind 2+i = 'leave' event at t + hi_i.
    kinds = [F.struct(F.lit(0).alias("k"), F.lit(0).cast("bigint").alias("s"))]
    if lo_us > 0:
        kinds.append(F.struct(F.lit(1).alias("k"), F.lit(lo_us).cast("bigint").alias("s")))
    kinds += [F.struct(F.lit(2 + i).alias("k"), F.lit(h).cast("bigint").alias("s"))
              for i, h in enumerate(hi_us)]
    ev = base.select(key, S.TX_US, *edges, *[f"__v_{n}" for n in names], _PAYLOAD,
                     F.inline(F.array(*kinds)))
    ev = ev.select(key, *edges, (F.col(S.TX_US) + F.col("s")).alias(_EVT), F.col("k").alias(_KIND),
                   F.when(F.col("k") == 0, F.col(_PAYLOAD)).alias(_PAYLOAD),
                   *[f"__v_{n}" for n in names])
    enter_kind = 0 if lo_us == 0 else 1
    contrib = {}
    for i in range(len(hi_us)):
        for n in names:
            v = F.col(f"__v_{n}")
            contrib[f"{n}@{i}"] = (F.when(F.col(_KIND) == enter_kind, v)
                                   .when(F.col(_KIND) == 2 + i, -v)
                                   .otherwise(F.lit(0)))
    at = time_slice(F.col(_EVT)) if edges else F.floor(F.col(_EVT) / F.lit(bucket_us))
    summed = bucketed_running_sum(ev, [key], F.when(F.col(_EVT).isNotNull(), at),
                                  [F.col(_EVT)], contrib, peers=True)
    return summed.where(F.col(_KIND) == 0).select(
        *[F.col(f"{_PAYLOAD}.{c}").alias(c) for c in df.columns if c not in edges],
        *[F.col(f"`{c}`") for c in contrib])


def _between(key: str, total: Column, hi_us: int, lo_us: int) -> Column:
    """``total`` (a count or an exact sum) over rows of the key with t - hi < t_j <= t - lo; 0 for a row
    without a time.  The total up to t - lo less the one up to t - hi: such frames only grow, so every
    row of a key is added once for each of them, however long the frame is."""
    w = Window.partitionBy(key).orderBy(S.TX_US)
    upto = lambda us: F.coalesce(total.over(w.rangeBetween(Window.unboundedPreceding, -us)), F.lit(0))
    return F.when(F.col(S.TX_US).isNotNull(), upto(lo_us) - upto(hi_us)).otherwise(F.lit(0))


def _dispatch(df: DataFrame, key: str, frame_fn, events_fn, strategy: str, bucket_us: int,
              hot_rows: int, hot=FIND) -> DataFrame:
    if strategy == "frame":
        return frame_fn(df)
    if strategy == "events":
        return events_fn(df, bucket_us)
    if strategy != "auto":
        raise ValueError(f"unknown strategy {strategy!r}")
    if hot is FIND:
        hot = hot_keys(df, key, S.TX_US, hot_rows)
    if hot is None:
        return frame_fn(df)
    cold_part = frame_fn(df.join(hot.select(key), key, "left_anti").select(df.columns))
    hot_part = events_fn(df.join(hot, key).select(*df.columns, EDGES), None)
    return cold_part.unionByName(hot_part)


def customer_spending_windows(df: DataFrame, windows=S.WINDOWS_DAYS, key: str = S.CUSTOMER_ID,
                              strategy: str = "auto", bucket_us: int = S.DAY_US,
                              hot_rows: int = HOT_KEY_ROWS, hot=FIND) -> DataFrame:
    """Count and mean amount of the key's rows in (t - N days, t].

    Adds ``{key}_NB_TX_{N}DAY_WINDOW`` (bigint) and
    ``{key}_AVG_AMOUNT_{N}DAY_WINDOW`` (double) for each N.
    Rows with a null key are dropped (they belong to no group).  ``hot`` may
    carry the result of :func:`hot_keys` for ``key`` (``auto`` only).
    """
    df = df.where(F.col(key).isNotNull())
    names = [(f"{key}_NB_TX_{n}DAY_WINDOW", f"{key}_AVG_AMOUNT_{n}DAY_WINDOW") for n in windows]

    def frame_fn(d: DataFrame) -> DataFrame:
        cols = []
        for n, (nb_name, avg_name) in zip(windows, names):
            cnt = _between(key, F.count(S.TX_AMOUNT), n * S.DAY_US, 0)
            amt = _between(key, F.sum(S.TX_AMOUNT), n * S.DAY_US, 0)
            cols += [cnt.cast("bigint").alias(nb_name),
                     F.try_divide(amt.cast("double"), cnt.cast("double")).alias(avg_name)]
        return d.select("*", *cols)

    def events_fn(d: DataFrame, width) -> DataFrame:
        amt = F.col(S.TX_AMOUNT)
        sums = _event_running_sums(
            d, key, 0, [n * S.DAY_US for n in windows],
            {"cnt": F.when(amt.isNotNull(), F.lit(1)).otherwise(F.lit(0)),
             "amt": F.coalesce(amt, F.lit(0).cast("decimal(18,2)"))},
            width)
        out = []
        for i, (nb_name, avg_name) in enumerate(names):
            cnt, sm = F.col(f"`cnt@{i}`"), F.col(f"`amt@{i}`")
            out += [cnt.cast("bigint").alias(nb_name),
                    F.try_divide(sm.cast("double"), cnt.cast("double")).alias(avg_name)]
        return sums.select(*[c for c in d.columns if c != EDGES], *out)

    return _dispatch(df, key, frame_fn, events_fn, strategy, bucket_us, hot_rows, hot)


def delayed_risk_windows(df: DataFrame, delay: int = S.DELAY_DAYS, windows=S.WINDOWS_DAYS,
                         key: str = S.TERMINAL_ID, strategy: str = "auto",
                         bucket_us: int = S.DAY_US, hot_rows: int = HOT_KEY_ROWS, hot=FIND) -> DataFrame:
    """For each N, rows and frauds of the key in (t-(d+N) days, t-d days].

    Adds ``{key}_NB_TX_{N}DAY_WINDOW`` (bigint) and ``{key}_RISK_{N}DAY_WINDOW``
    = frauds / rows, 0 when the frame is empty.
    """
    df = df.where(F.col(key).isNotNull())
    names = [(f"{key}_NB_TX_{n}DAY_WINDOW", f"{key}_RISK_{n}DAY_WINDOW") for n in windows]

    def frame_fn(d: DataFrame) -> DataFrame:
        cols = []
        for n, (nb_name, risk_name) in zip(windows, names):
            nb = _between(key, F.count(S.TX_FRAUD), (delay + n) * S.DAY_US, delay * S.DAY_US)
            fr = _between(key, F.sum(S.TX_FRAUD), (delay + n) * S.DAY_US, delay * S.DAY_US)
            cols += [nb.cast("bigint").alias(nb_name), safe_ratio(fr, nb).alias(risk_name)]
        return d.select("*", *cols)

    def events_fn(d: DataFrame, width) -> DataFrame:
        fraud = F.col(S.TX_FRAUD)
        sums = _event_running_sums(
            d, key, delay * S.DAY_US, [(delay + n) * S.DAY_US for n in windows],
            {"nb": F.when(fraud.isNotNull(), F.lit(1)).otherwise(F.lit(0)),
             "fr": F.coalesce(fraud, F.lit(0)).cast("bigint")},
            width)
        out = []
        for i, (nb_name, risk_name) in enumerate(names):
            nb, fr = F.col(f"`nb@{i}`"), F.col(f"`fr@{i}`")
            out += [nb.cast("bigint").alias(nb_name), safe_ratio(fr, nb).alias(risk_name)]
        return sums.select(*[c for c in d.columns if c != EDGES], *out)

    return _dispatch(df, key, frame_fn, events_fn, strategy, bucket_us, hot_rows, hot)

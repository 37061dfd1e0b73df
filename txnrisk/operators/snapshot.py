"""Last-known feature snapshot per key (W4) and snapshot enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schema as S
from ..functions.numeric import safe_ratio


def last_per_key(df: DataFrame, key: str, cols: list[str], order=(S.TX_US, S.TX_ID)) -> DataFrame:
    """The latest row of each key (ties on time broken by the larger id).

    ``max_by`` is an aggregate with map-side combine: every task reduces its
    rows to one per key before the shuffle, so a hot key costs nothing extra
    and there is no sort of the input."""
    payload = F.struct(*[F.col(c) for c in cols])
    ordering = F.struct(*[F.col(c) for c in order])
    return (df.where(F.col(key).isNotNull())
              .groupBy(key).agg(F.max_by(payload, ordering).alias("__last"))
              .select(key, *[F.col(f"__last.{c}").alias(c) for c in cols]))


def customer_snapshot(features: DataFrame, windows=S.WINDOWS_DAYS) -> DataFrame:
    """The last features of each customer; rows without a time are not among them."""
    return last_per_key(features.where(F.col(S.TX_US).isNotNull()), S.CUSTOMER_ID, [S.TX_DATETIME] + S.customer_feature_names(windows))


def terminal_snapshot(features: DataFrame, windows=S.WINDOWS_DAYS) -> DataFrame:
    """The last features of each terminal; rows without a time are not among them."""
    return last_per_key(features.where(F.col(S.TX_US).isNotNull()), S.TERMINAL_ID, [S.TX_DATETIME] + S.terminal_feature_names(windows))


def _in_reach(rows: DataFrame, last: DataFrame, key: str, reach_us: int) -> DataFrame:
    """Rows of each key at most ``reach_us`` before the key's last time ``__t``."""
    return rows.join(last.select(key, "__t"), key).where(
        (F.col(S.TX_US) <= F.col("__t")) & (F.col(S.TX_US) > F.col("__t") - F.lit(reach_us)))


def _last_times(tx: DataFrame, key: str) -> DataFrame:
    """(key, TX_DATETIME, __t) of the latest full row: the last of equal times has the same time."""
    full = tx.where(F.col(S.CUSTOMER_ID).isNotNull() & F.col(S.TERMINAL_ID).isNotNull() & F.col(S.TX_US).isNotNull())
    return full.groupBy(key).agg(F.max(S.TX_DATETIME).alias(S.TX_DATETIME), F.max(S.TX_US).alias("__t"))


def customer_snapshot_of(tx: DataFrame, windows=S.WINDOWS_DAYS) -> DataFrame:
    """:func:`customer_snapshot` of the feature table, straight from transactions.

    Only the windows of each customer's last row are computed: its time by a
    pre-aggregated maximum, then sums over the rows in reach of it.  No window
    is evaluated for the other rows."""
    key, amt = S.CUSTOMER_ID, F.col(S.TX_AMOUNT)
    last = _last_times(tx, key)
    near = _in_reach(tx.where(F.col(key).isNotNull()), last, key, max(windows) * S.DAY_US)
    inside = {n: F.col(S.TX_US) > F.col("__t") - F.lit(n * S.DAY_US) for n in windows}
    sums = near.groupBy(key).agg(
        *[F.count(F.when(inside[n], amt)).alias(f"__c{n}") for n in windows],
        *[F.sum(F.when(inside[n], amt)).alias(f"__s{n}") for n in windows])
    cols = []
    for n in windows:
        cols += [F.coalesce(F.col(f"__c{n}"), F.lit(0)).cast("bigint").alias(f"{key}_NB_TX_{n}DAY_WINDOW"),
                 F.try_divide(F.col(f"__s{n}").cast("double"), F.col(f"__c{n}").cast("double")).alias(f"{key}_AVG_AMOUNT_{n}DAY_WINDOW")]
    return last.join(sums, key, "left").select(key, S.TX_DATETIME, *cols).select(key, S.TX_DATETIME, *S.customer_feature_names(windows))


def terminal_snapshot_of(tx: DataFrame, delay: int = S.DELAY_DAYS, windows=S.WINDOWS_DAYS) -> DataFrame:
    """:func:`terminal_snapshot` of the feature table, straight from transactions."""
    key, fraud = S.TERMINAL_ID, F.col(S.TX_FRAUD)
    last = _last_times(tx, key)
    rows = tx.where(F.col(S.CUSTOMER_ID).isNotNull() & F.col(key).isNotNull())
    near = _in_reach(rows, last, key, (delay + max(windows)) * S.DAY_US).where(
        F.col(S.TX_US) <= F.col("__t") - F.lit(delay * S.DAY_US))
    inside = {n: F.col(S.TX_US) > F.col("__t") - F.lit((delay + n) * S.DAY_US) for n in windows}
    sums = near.groupBy(key).agg(
        *[F.count(F.when(inside[n], fraud)).alias(f"__c{n}") for n in windows],
        *[F.sum(F.when(inside[n], fraud)).alias(f"__s{n}") for n in windows])
    cols = []
    for n in windows:
        cols += [F.coalesce(F.col(f"__c{n}"), F.lit(0)).cast("bigint").alias(f"{key}_NB_TX_{n}DAY_WINDOW"),
                 safe_ratio(F.col(f"__s{n}"), F.col(f"__c{n}")).alias(f"{key}_RISK_{n}DAY_WINDOW")]
    return last.join(sums, key, "left").select(key, S.TX_DATETIME, *cols).select(key, S.TX_DATETIME, *S.terminal_feature_names(windows))


def enrich(requests: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    """Left join a snapshot on ``key``; the snapshot's own time is dropped so
    the request keeps its TX_DATETIME.  Unknown keys get null features.

    No broadcast hint: a snapshot has one row per key and grows with the key
    space, so AQE decides from its measured size (and splits skewed request
    partitions when it has to shuffle)."""
    snap = snapshot.drop(S.TX_DATETIME)
    return requests.join(snap, on=key, how="left")

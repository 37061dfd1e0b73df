"""Calendar and time-offset expressions (all JVM-side, codegen-friendly).

Timestamps are TIMESTAMP_NTZ throughout, like the zone-less timestamps of
the workload, so no result depends on the session time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F

from .. import schema as S


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_literal(x) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime, date or ISO string.

    Built by casting the ISO text: ``F.lit(datetime)`` would make a zoned
    timestamp (via the Python process's zone) and a later cast would apply the
    session zone, so the wall-clock value could shift between machines."""
    if isinstance(x, _dt.datetime):
        x = x.isoformat(sep=" ")
    elif isinstance(x, _dt.date):
        x = x.isoformat()
    return F.lit(str(x)).cast("timestamp_ntz")


def _epoch() -> Column:
    return ntz_literal("1970-01-01 00:00:00")


def _lit_ts(origin) -> Column:
    if isinstance(origin, Column):
        return origin.cast("timestamp_ntz")
    return ntz_literal(origin)


def to_ntz(c) -> Column:
    """Zone-less timestamp from a timestamp / timestamp_ntz / date column."""
    return _c(c).cast("timestamp_ntz")


def weekend_flag(ts) -> Column:
    """1 when the day is Saturday or Sunday (weekday() is Monday = 0)."""
    return (F.weekday(_c(ts)) >= S.WEEKEND_FIRST_WEEKDAY).cast("bigint")


def night_flag(ts) -> Column:
    """1 when hour <= 6 or hour >= 22."""
    h = F.hour(_c(ts))
    return ((h <= S.NIGHT_LAST_MORNING_HOUR) | (h >= S.NIGHT_FIRST_EVENING_HOUR)).cast("bigint")


def epoch_us(ts) -> Column:
    """Microseconds since the epoch of a zone-less timestamp (a sortable long).

    Built from calendar fields of the TIMESTAMP_NTZ value (days since epoch,
    hour, minute, seconds with fraction), so no session time zone and no DST
    rule can shift it; ``unix_micros`` / ``timestampdiff`` would first cast to
    a zoned timestamp in the session zone.
    """
    t = to_ntz(ts)
    return (F.unix_date(F.to_date(t)).cast("bigint") * F.lit(86_400_000_000)
            + F.hour(t).cast("bigint") * F.lit(3_600_000_000)
            + F.minute(t).cast("bigint") * F.lit(60_000_000)
            + (F.date_part(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("bigint"))


def day_offset(ts, origin) -> Column:
    """Whole days from the date of ``origin`` to the date of ``ts`` (TX_TIME_DAYS)."""
    return F.datediff(F.to_date(_c(ts)), F.to_date(_lit_ts(origin))).cast("bigint")


def second_offset(ts, origin) -> Column:
    """Seconds from ``origin`` to ``ts`` (TX_TIME_SECONDS), floored."""
    return F.floor((epoch_us(ts) - epoch_us(_lit_ts(origin))) / 1_000_000).cast("bigint")


def from_offset_seconds(seconds, origin) -> Column:
    """origin + seconds (inverse of :func:`second_offset`)."""
    return F.timestamp_add("SECOND", _c(seconds), _lit_ts(origin))


def from_epoch_ms(ms) -> Column:
    """Epoch milliseconds -> zone-less timestamp (request payloads)."""
    return F.timestamp_add("MILLISECOND", _c(ms).cast("bigint"), _epoch())


def parse_day(text) -> Column:
    """Parse a ``yyyy-MM-dd`` string."""
    return F.to_timestamp_ntz(_c(text), F.lit("yyyy-MM-dd"))


def add_days(ts, n) -> Column:
    return F.timestamp_add("DAY", n if isinstance(n, Column) else F.lit(n), _c(ts))

"""Calendar flags (F1/F2) as a projection."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import schema as S
from ..functions.time import night_flag, weekend_flag


def add_calendar_flags(df: DataFrame, ts: str = S.TX_DATETIME) -> DataFrame:
    """Append TX_DURING_WEEKEND and TX_DURING_NIGHT (0/1 bigint)."""
    return df.select("*", weekend_flag(ts).alias(S.WEEKEND), night_flag(ts).alias(S.NIGHT))

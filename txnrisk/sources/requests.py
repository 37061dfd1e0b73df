"""Score requests (S3) and score replies (S4) as JSON.

A request record is ``{"TRANSACTION_ID", "TX_DATETIME", "CUSTOMER_ID",
"TERMINAL_ID", "TX_AMOUNT"}`` where TX_DATETIME is epoch milliseconds (or a
timestamp string).  A reply record is ``{"TRANSACTION_ID", "prob_fraud"}``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import schema as S
from ..functions.time import from_epoch_ms

REQUEST_SCHEMA = T.StructType([
    T.StructField(S.TX_ID, T.LongType()),
    T.StructField(S.TX_DATETIME, T.StringType()),   # epoch ms or a timestamp text
    T.StructField(S.CUSTOMER_ID, T.LongType()),
    T.StructField(S.TERMINAL_ID, T.LongType()),
    T.StructField(S.TX_AMOUNT, T.DoubleType()),
])


def request_time(raw) -> Column:
    """Epoch-ms digits -> timestamp_ntz; any other text is parsed as a timestamp."""
    c = F.col(raw) if isinstance(raw, str) else raw
    return F.when(c.rlike(r"^-?[0-9]+$"), from_epoch_ms(c.cast("bigint"))) \
        .otherwise(c.try_cast("timestamp_ntz"))   # never through the session zone


RAW, CORRUPT = "raw", "corrupt"
CHECKED_SCHEMA = T.StructType([*REQUEST_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def normalize_requests(df: DataFrame) -> DataFrame:
    """Typed request rows from the raw JSON fields."""
    return df.select(
        F.col(S.TX_ID).cast("bigint").alias(S.TX_ID),
        request_time(F.col(S.TX_DATETIME).cast("string")).alias(S.TX_DATETIME),
        F.col(S.CUSTOMER_ID).cast("bigint").alias(S.CUSTOMER_ID),
        F.col(S.TERMINAL_ID).cast("bigint").alias(S.TERMINAL_ID),
        F.col(S.TX_AMOUNT).cast("double").alias(S.TX_AMOUNT))


@dataclass(frozen=True)
class Parsed:
    """Requests that may be scored, and the raw text (``raw``) of records that may not: malformed JSON, a
    field of another type, a time that is none, or no transaction id."""

    requests: DataFrame
    quarantined: DataFrame


def sort_out_records(records: DataFrame) -> Parsed:
    """``records``: the request fields, the record's text in ``corrupt`` where the parser rejected it,
    and its text in ``raw`` (without that column, the fields written again)."""
    if RAW not in records.columns:
        records = records.withColumn(RAW, F.to_json(F.struct(*REQUEST_SCHEMA.fieldNames())))
    time = F.col(S.TX_DATETIME)
    bad = (F.col(CORRUPT).isNotNull() | F.col(S.TX_ID).isNull()
           | (time.isNotNull() & request_time(time.cast("string")).isNull()))
    return Parsed(normalize_requests(records.where(~bad)), records.where(bad).select(F.coalesce(CORRUPT, RAW).alias(RAW)))


def _fields(record: str) -> list[Column]:
    return [F.col(f"{record}.{f.name}").alias(f.name) for f in REQUEST_SCHEMA.fields]


def sort_out_lines(df: DataFrame, col: str = "value") -> Parsed:
    """One JSON record per row (e.g. a text or Kafka value column).

    The parsed record passes through ``explode``: conditions on its fields stay above that, where they
    would otherwise move below the parser, each with a parse of its own."""
    parsed = df.select(F.col(col).alias(RAW), F.explode(F.array(F.from_json(F.col(col), CHECKED_SCHEMA, _PERMISSIVE))).alias("r"))
    corrupt = F.when(F.col("r").isNull(), F.coalesce(RAW, F.lit(""))).otherwise(F.col(f"r.{CORRUPT}"))
    return sort_out_records(parsed.select(*_fields("r"), RAW, corrupt.alias(CORRUPT)))


def sort_out_arrays(df: DataFrame, col: str = "body") -> Parsed:
    """One JSON array of records per row (an API body).  A body that is no array is quarantined
    whole; of others, each record by itself."""
    items = F.from_json(F.col(col), T.ArrayType(T.StringType()))      # each record as its own text
    whole = df.select(F.col(col).alias("b"), items.alias("items"))
    records = sort_out_lines(whole.select(F.explode("items").alias("value")))
    bodies = whole.where(F.col("items").isNull()).select(F.coalesce("b", F.lit("")).alias(RAW))
    return Parsed(records.requests, records.quarantined.unionByName(bodies))


def sort_out_files(spark: SparkSession, path: str, multi_line: bool = False) -> Parsed:
    """Request files: JSON lines, or (``multi_line``) files holding a JSON array."""
    text = spark.read.option("wholetext", multi_line).text(path)
    if multi_line:
        return sort_out_arrays(text, "value")
    return sort_out_lines(text.where(F.trim("value") != ""))


def read_requests(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The good requests of :func:`sort_out_files`."""
    return sort_out_files(spark, path, multi_line).requests


def parse_request_lines(df: DataFrame, col: str = "value") -> DataFrame:
    """The good requests of :func:`sort_out_lines`: a malformed record is never scored."""
    return sort_out_lines(df, col).requests


def parse_request_arrays(df: DataFrame, col: str = "body") -> DataFrame:
    """The good requests of :func:`sort_out_arrays`."""
    return sort_out_arrays(df, col).requests


def request_line() -> Column:
    """The JSON request of a stored transaction (time as epoch ms)."""
    return F.to_json(F.struct(
        F.col(S.TX_ID),
        F.floor(F.col(S.TX_US) / 1000).cast("bigint").alias(S.TX_DATETIME),
        F.col(S.CUSTOMER_ID), F.col(S.TERMINAL_ID),
        F.col(S.TX_AMOUNT).cast("double").alias(S.TX_AMOUNT)))


def requests_from_transactions(tx: DataFrame) -> DataFrame:
    """Request JSON lines built from stored transactions."""
    return tx.select(request_line().alias("value"))


def reply_records(scored: DataFrame, prob: str = "prob_fraud") -> DataFrame:
    """One JSON reply record per request."""
    return scored.select(F.to_json(F.struct(F.col(S.TX_ID), F.col(prob).alias("prob_fraud"))).alias("value"))


def write_replies(scored: DataFrame, path: str, prob: str = "prob_fraud", mode: str = "overwrite") -> None:
    scored.select(S.TX_ID, F.col(prob).alias("prob_fraud")).write.mode(mode).json(path)

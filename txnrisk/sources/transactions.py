"""The transactions table (S1/S2) and its mapping onto the ``events`` table.

``events`` columns map to the transaction schema as:
TRANSACTION_ID = event_id, TX_DATETIME = ts, CUSTOMER_ID = user_id,
TERMINAL_ID = props.k, TX_AMOUNT = value (two decimals), TX_FRAUD =
(event_type = 'error' and value > 100).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schema as S
from ..functions import time as tf
from .tables import read_table

# Fixed values of the events mapping.
EVENTS_ORIGIN = "2024-01-01"
FRAUD_EVENT_TYPE = "error"
FRAUD_MIN_VALUE = 100

TRANSACTIONS_SCHEMA = T.StructType([
    T.StructField(S.TX_ID, T.LongType()),
    T.StructField(S.TX_DATETIME, T.TimestampNTZType()),
    T.StructField(S.TX_US, T.LongType()),
    T.StructField(S.CUSTOMER_ID, T.LongType()),
    T.StructField(S.TERMINAL_ID, T.LongType()),
    T.StructField(S.TX_AMOUNT, T.DecimalType(18, 2)),
    T.StructField(S.TX_TIME_SECONDS, T.LongType()),
    T.StructField(S.TX_TIME_DAYS, T.LongType()),
    T.StructField(S.TX_FRAUD, T.LongType()),
])

LABELLED_SCHEMA = T.StructType(TRANSACTIONS_SCHEMA.fields + [T.StructField(S.TX_FRAUD_SCENARIO, T.LongType())])


def transactions_from_events(events: DataFrame, origin: str = EVENTS_ORIGIN) -> DataFrame:
    """Project ``events`` onto the transaction schema (narrow, no shuffle)."""
    ts = tf.to_ntz("ts")
    return events.select(
        F.col("event_id").cast("bigint").alias(S.TX_ID),
        ts.alias(S.TX_DATETIME),
        tf.epoch_us(ts).alias(S.TX_US),
        F.col("user_id").cast("bigint").alias(S.CUSTOMER_ID),
        F.get_json_object("props", "$.k").cast("bigint").alias(S.TERMINAL_ID),
        F.col("value").cast("decimal(18,2)").alias(S.TX_AMOUNT),
        tf.second_offset(ts, origin).alias(S.TX_TIME_SECONDS),
        tf.day_offset(ts, origin).alias(S.TX_TIME_DAYS),
        ((F.col("event_type") == FRAUD_EVENT_TYPE) & (F.col("value") > FRAUD_MIN_VALUE))
        .cast("bigint").alias(S.TX_FRAUD),
    )


def load_transactions(spark: SparkSession, sf_dir: str, origin: str = EVENTS_ORIGIN) -> DataFrame:
    return transactions_from_events(read_table(spark, sf_dir, "events"), origin)


def write_transactions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store transactions laid out by day, so time splits prune partitions.

    Range partitioning on (day, customer, time) splits a large day over many
    tasks instead of one per day, and clusters rows by customer inside each
    file, which keeps row-group min/max statistics tight for key lookups.
    """
    (df.repartitionByRange(S.TX_TIME_DAYS, S.CUSTOMER_ID, S.TX_US)
       .sortWithinPartitions(S.TX_TIME_DAYS, S.CUSTOMER_ID, S.TX_US)
       .write.mode(mode).partitionBy(S.TX_TIME_DAYS).parquet(path))


def read_transactions(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a table written by :func:`write_transactions` with a fixed schema."""
    sch = schema or TRANSACTIONS_SCHEMA
    return spark.read.schema(sch).parquet(path).select(*sch.fieldNames())

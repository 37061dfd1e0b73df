import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from txnrisk.session import build_session
    s = build_session("local[4]", shuffle_partitions=8)
    yield s


def ts(s):
    import datetime as dt
    return dt.datetime.fromisoformat(s)


def make_tx(spark, rows):
    """rows: (id, 'YYYY-MM-DD HH:MM:SS[.ffffff]', customer, terminal, amount, fraud)"""
    from decimal import Decimal

    from pyspark.sql import functions as F

    from txnrisk import schema as S
    from txnrisk.functions import time as tf
    data = [(i, ts(t), c, k, Decimal(str(a)).quantize(Decimal("0.01")), f) for i, t, c, k, a, f in rows]
    df = spark.createDataFrame(
        data, "TRANSACTION_ID bigint, TX_DATETIME timestamp_ntz, CUSTOMER_ID bigint, TERMINAL_ID bigint, "
              "TX_AMOUNT decimal(18,2), TX_FRAUD bigint")
    return df.select(S.TX_ID, S.TX_DATETIME, tf.epoch_us(S.TX_DATETIME).alias(S.TX_US), S.CUSTOMER_ID,
                     S.TERMINAL_ID, S.TX_AMOUNT,
                     tf.second_offset(S.TX_DATETIME, "2024-01-01").alias(S.TX_TIME_SECONDS),
                     tf.day_offset(S.TX_DATETIME, "2024-01-01").alias(S.TX_TIME_DAYS),
                     F.col(S.TX_FRAUD))

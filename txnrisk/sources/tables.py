"""Parquet table access for the driver-provided data folders."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet``.  Column pruning and filter pushdown are
    left to Catalyst: callers select what they use and the scan reads only that."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))

"""Line-oriented text and Parquet readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``; files split across tasks."""
    return spark.read.text(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Self-describing columnar input; filters and projections reach the scan."""
    return spark.read.parquet(path)

"""Writers: Parquet (replace), one-column text (fails if present), CSV, models."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fundcast.sinks.publish import publish_parquet, read_published

LOSSLESS_WRITE = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_parquet(df: DataFrame, path: str) -> str:
    """Replace ``path`` with ``df`` as Parquet (no shuffle is added). A write that ends
    midway leaves neither version whole; ``publish_parquet`` does."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_text(df: DataFrame, column: str, path: str) -> str:
    """Write one string column as text lines; errors if ``path`` exists."""
    df.select(column).write.text(path)
    return path


def write_lines_with_header(df: DataFrame, header: str, path: str) -> str:
    """Write a one-column frame as text lines below ``header`` in every file, the lines
    as they are (no quoting); errors if ``path`` exists."""
    as_is = {"quote": "", "sep": "\x01", "escape": "\x00", "emptyValue": "", "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}
    df.toDF(header).write.option("header", "true").options(**as_is).csv(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> str:
    """CSV that reads back losslessly with ``fundcast.sources.csv`` readers:
    quotes escaped by doubling, no whitespace trimming."""
    writer = df.write.mode(mode).option("header", str(header).lower())
    for k, v in LOSSLESS_WRITE.items():
        writer = writer.option(k, v)
    writer.csv(path)
    return path


def save_model(model, path: str) -> str:
    """Save a fitted model (pipeline, tuned split, …), replacing ``path``."""
    model.write().overwrite().save(path)
    return path


__all__ = [
    "write_parquet", "write_text", "write_lines_with_header", "write_csv", "save_model", "publish_parquet", "read_published", "LOSSLESS_WRITE",
]

"""Profiling reports returned as DataFrames (never printed, never collected).

Each report is one aggregation plan: grouped counts use partial (map-side)
plus final hash aggregation, so a hot key costs one row per task before the
shuffle; top-k reports plan as ``TakeOrderedAndProject`` (a per-task heap)
instead of a full sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    """One row ``n_rows``. (For DROPMALFORMED CSV input, read it with
    ``read_strict_csv`` so the count sees the same rows a ``collect`` does.)"""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and number of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns")
    )


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: 1-based position, name, Spark type and the count
    of non-null values (one pass over the data for all columns)."""
    counts = df.agg(*[F.count(F.col(c)).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("col_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"_n{i}").alias("non_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def preview(df: DataFrame, n: int = 20, order_by: list[str | Column] | None = None) -> DataFrame:
    """First ``n`` rows; give ``order_by`` for a repeatable answer."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)


def describe_numeric(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """count, mean, sample stddev, min, max per column, one row per column.

    All statistics of all columns come from a single aggregation; mean and
    stddev are rounded to ``digits`` decimals. ``df.describe`` gives the same
    figures as strings in a wide layout.
    """
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c)
        aggs += [
            F.count(x).alias(f"n{i}"),
            F.avg(x).alias(f"m{i}"),
            F.stddev_samp(x).alias(f"s{i}"),
            F.min(x).cast("double").alias(f"lo{i}"),
            F.max(x).cast("double").alias(f"hi{i}"),
        ]
    wide = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n{i}").alias("count"),
            F.round(F.col(f"m{i}"), digits).alias("mean"),
            F.round(F.col(f"s{i}"), digits).alias("stddev"),
            F.col(f"lo{i}").alias("min"),
            F.col(f"hi{i}").alias("max"),
        )
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def frequency(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key combination (null is a group), most frequent first,
    ties by key (nulls first)."""
    order = [F.desc("count")] + [F.asc_nulls_first(k) for k in keys]
    return df.groupBy(*keys).count().orderBy(*order)


def frequencies(df: DataFrame, keys: list[str]) -> DataFrame:
    """Frequency tables of several columns from one scan: (column, value,
    count), values as strings, null a group of its own.

    A grouping-sets aggregate expands each row once per key and
    partial-aggregates before the single shuffle, instead of scanning the
    input once per key as separate ``frequency`` calls would.
    """
    n = len(keys)
    cols = [F.col(k).cast("string").alias(k) for k in keys]
    counted = df.select(*cols).groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("count"), F.grouping_id().alias("_gid")
    )
    name = None
    value = None
    for i, k in enumerate(keys):
        gid = (1 << n) - 1 - (1 << (n - 1 - i))
        hit = F.col("_gid") == gid
        name = F.when(hit, F.lit(k)) if name is None else name.when(hit, F.lit(k))
        value = F.when(hit, F.col(k)) if value is None else value.when(hit, F.col(k))
    return counted.select(name.alias("column"), value.alias("value"), "count")


def top_k(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The ``n`` most frequent key combinations (ties by key)."""
    return frequency(df, *keys).limit(n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).dropDuplicates()


def filtered_frequency(df: DataFrame, condition: Column, *keys: str) -> DataFrame:
    """Frequency table of the rows matching ``condition``."""
    return frequency(df.filter(condition), *keys)

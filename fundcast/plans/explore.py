"""Campaign exploration report: the profile tables of the preparation job,
returned lazily (nothing is printed or collected), as one long table from one scan
(``report``) or as named DataFrames (``explore``).

The original job re-read its CSV for each of ~20 reports; ``snapshot`` turns
the CSV into Parquet once so that every report scans only the columns it
needs from a columnar copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundcast.operators import profile
from fundcast.plans import prepare as P
from fundcast.sinks import write_parquet
from fundcast.sources import read_campaign_csv, read_parquet


def snapshot(spark: SparkSession, csv_path: str, parquet_path: str, schema=None, lossless: bool = False) -> DataFrame:
    """Read the campaign CSV once (null token ``false``) and keep it as Parquet.
    ``lossless`` reads cells with quotes and line breaks, one task per file."""
    write_parquet(read_campaign_csv(spark, csv_path, schema=schema, lossless=lossless), parquet_path)
    return read_parquet(spark, parquet_path)


def explore(raw: DataFrame, null_token_value: str | None = None) -> dict[str, DataFrame]:
    """All exploration reports of a raw campaign frame. Pass
    ``null_token_value='false'`` when ``raw`` did not come through the CSV
    reader's ``nullValue`` option."""
    cast = P.cast_columns(P.apply_null_token(raw, null_token_value))
    repaired = P.lower_text(P.repair_country_currency(P.drop_leakage(cast)))
    prepared = P.prepare(raw, null_token_value)
    return {
        "shape": profile.shape(raw),
        "schema": profile.schema_report(raw),
        "preview": profile.preview(raw, 20),
        "cast_schema": profile.schema_report(cast),
        "class_balance": profile.frequency(cast, "final_status"),
        "frequencies": profile.frequencies(
            cast, ["disable_communication", "country", "currency", "state_changed_at", "backers_count"]
        ),
        "describe": profile.describe_numeric(cast, ["goal", "backers_count", "final_status"]),
        "disable_communication": profile.top_k(cast, ["disable_communication"], 100),
        "country": profile.top_k(cast, ["country"], 100),
        "currency": profile.top_k(cast, ["currency"], 100),
        "deadlines": profile.distinct_values(cast, "deadline"),
        "state_changed_at": profile.top_k(cast, ["state_changed_at"], 100),
        "backers_count": profile.top_k(cast, ["backers_count"], 100),
        "goal_status": profile.preview(cast.select("goal", "final_status"), 30),
        "country_currency": profile.top_k(cast, ["country", "currency"], 50),
        "missing_country_currencies": profile.top_k(cast.filter(F.col("country").isNull()), ["currency"], 50),
        "country2_currency2": profile.top_k(repaired, ["country2", "currency2"], 50),
        "country2": profile.top_k(repaired, ["country2"], 100),
        "currency2": profile.top_k(repaired, ["currency2"], 100),
        "prepared_balance": profile.frequency(prepared, "final_status"),
        "prepared_preview": profile.preview(prepared, 50),
        "prepared_shape": profile.shape(prepared),
    }


#: How many groups a report of the long table keeps: its most frequent ones.
TOP = 100
TOP_PAIRS = 50
_NUMBERS = ("goal", "backers_count", "final_status")


def _line(report: str, key1=None, key2=None, value=None, where=None):
    """What a row says to a report: its group and a number, or nothing."""
    text = lambda c: F.lit(None).cast("string") if c is None else c.cast("string")
    number = F.lit(None).cast("double") if value is None else value.cast("double")
    said = F.struct(
        F.lit(report).alias("report"), text(key1).alias("key1"), text(key2).alias("key2"), number.alias("value")
    )
    return said if where is None else F.when(F.coalesce(where, F.lit(False)), said)


def report(raw: DataFrame, null_token_value: str | None = None, digits: int = 6) -> DataFrame:
    """Every counting report of the exploration as one long table, from one scan.

    (report, key1, key2, place, n_rows, n_values, mean, stddev, min, max): a row says
    its group to every report, and a single aggregate by (report, group), combined
    before its one shuffle, counts them all. ``columns`` holds the non-null values of
    every column once the null token and the casts are applied, ``describe`` the figures of the numbers, ``prepared`` the rows
    that the preparation keeps; the others are frequencies, of which the most frequent
    groups stay (ties by key, nulls first), at most ``TOP`` (``TOP_PAIRS`` of two keys):
    tasks send no more than that on."""
    cast = P.cast_columns(P.apply_null_token(raw, null_token_value))
    full = P.durations(cast)
    country2, currency2 = P.repair_country("country", "currency"), P.repair_currency("currency")
    kept = (F.col("hours_prepa") >= 0) & (F.col("days_campaign") >= 0) & (F.col("goal") > 0) & F.col("final_status").isin(*P.LABELS)
    present = [F.col(c).isNotNull() for c in raw.columns]
    one = F.lit(1.0)
    said = [
        *[_line("columns", F.lit(c), None, F.when(there, one)) for c, there in zip(raw.columns, present)],
        *[_line("describe", F.lit(c), None, F.col(c)) for c in _NUMBERS],
        *[_line(c, F.col(c)) for c in (
            "final_status", "disable_communication", "country", "currency", "state_changed_at", "backers_count", "deadline"
        )],
        _line("country, currency", F.col("country"), F.col("currency")),
        _line("currency of missing country", F.col("currency"), where=F.col("country").isNull()),
        _line("country2, currency2", country2, currency2),
        _line("country2", country2),
        _line("currency2", currency2),
        _line("prepared", F.col("final_status"), where=kept),
    ]
    lines = full.select(F.explode_outer(F.array(*said)).alias("s")).where("s is not null").select("s.*")
    x = F.col("value")
    counted = lines.groupBy("report", "key1", "key2").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(x).alias("n_values"), F.round(F.avg(x), digits).alias("mean"),
        F.round(F.stddev_samp(x), digits).alias("stddev"), F.min(x).alias("min"), F.max(x).alias("max"),
    )
    order = Window.partitionBy("report").orderBy(F.desc("n_rows"), F.asc_nulls_first("key1"), F.asc_nulls_first("key2"))
    most = F.when(F.col("report").contains(","), TOP_PAIRS).otherwise(TOP)
    placed = counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= TOP)
    return placed.where(F.col("place") <= most).select(
        "report", "key1", "key2", "place", "n_rows", "n_values", "mean", "stddev", "min", "max"
    )

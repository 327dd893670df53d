"""Campaign preparation: raw campaign rows → training-ready rows.

One narrow plan (scan → project → filter → write): no shuffle, every step a
built-in expression, so the whole chain is a single code-generated stage.
Filters on columns that are INT in the source (``final_status``, ``goal``) reach
a Parquet scan; behind a cast only their null checks could.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from fundcast.functions import (
    calendar_days,
    epoch_to_text,
    hours_between,
    join_text,
    lenient_int,
    null_token,
    repair_country,
    repair_currency,
)
from fundcast.session import use_utc

INT_COLUMNS = (
    "goal",
    "deadline",
    "state_changed_at",
    "created_at",
    "launched_at",
    "backers_count",
    "final_status",
)
# Known only after a campaign ends: would leak the outcome into training.
LEAKAGE_COLUMNS = ("backers_count", "state_changed_at")
TEXT_COLUMNS = ("name", "desc", "keywords")
FILL_VALUES = {"days_campaign": -1, "hours_prepa": -1, "goal": -1}
LABELS = (0, 1)


def apply_null_token(df: DataFrame, token: str | None = "false") -> DataFrame:
    """Null every string cell equal to ``token`` — what the CSV reader's
    ``nullValue`` does, for input that did not come through that reader."""
    if token is None:
        return df
    strings = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: null_token(c, token) for c in strings})


def cast_columns(df: DataFrame, columns=INT_COLUMNS) -> DataFrame:
    """Lenient INT casts of the numeric campaign columns (bad value → null).
    Columns that are INT already stay as they are, so filters on them reach the scan."""
    present = [c for c in columns if c in df.columns and df.schema[c].dataType != IntegerType()]
    if not present:
        return df
    return df.withColumns({c: lenient_int(c) for c in present})


def drop_leakage(df: DataFrame) -> DataFrame:
    """Drop the constant column and the columns known only after the end."""
    return df.drop("disable_communication", *LEAKAGE_COLUMNS)


def repair_country_currency(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "country2": repair_country("country", "currency"),
            "currency2": repair_currency("currency"),
        }
    ).drop("country", "currency")


def lower_text(df: DataFrame, columns=TEXT_COLUMNS) -> DataFrame:
    return df.withColumns({c: F.lower(c) for c in columns})


def durations(df: DataFrame) -> DataFrame:
    """Readable dates, campaign length in days and preparation time in hours.
    Pins the session time zone to UTC first: both depend on it, and it is
    captured when the plan is built."""
    use_utc(df.sparkSession)
    return df.withColumns(
            {
                "deadline2": epoch_to_text("deadline"),
                "created_at2": epoch_to_text("created_at"),
                "launched_at2": epoch_to_text("launched_at"),
            }
        ).withColumns(
            {
                "days_campaign": calendar_days("deadline2", "launched_at2"),
                "hours_prepa": hours_between("launched_at", "created_at"),
            }
        )


def add_durations(df: DataFrame) -> DataFrame:
    """``durations`` then keep non-negative ones and drop the raw epochs.

    The filter is on the *rounded* hours, so launched − created of −1 s
    (→ 0.0) is kept and −2 s is removed.
    """
    return (
        durations(df)
        .filter((F.col("hours_prepa") >= 0) & (F.col("days_campaign") >= 0))
        .drop("created_at", "deadline", "launched_at")
    )


def add_text(df: DataFrame) -> DataFrame:
    return df.withColumn("text", join_text(*TEXT_COLUMNS))


def fill_missing(df: DataFrame, values: dict | None = None) -> DataFrame:
    """Per-column null fill. After the range filters above it cannot fire
    (comparisons already dropped nulls); it is kept for inputs that skip them."""
    return df.fillna(values or FILL_VALUES)


def keep_labels(df: DataFrame, labels=LABELS) -> DataFrame:
    """Keep rows labelled 0 or 1; other states and null labels go."""
    return df.filter(F.col("final_status").isin(*labels))


def prepare(raw: DataFrame, null_token_value: str | None = "false") -> DataFrame:
    """The full preparation chain, in the original order."""
    use_utc(raw.sparkSession)
    df = apply_null_token(raw, null_token_value)
    df = cast_columns(df)
    df = drop_leakage(df)
    df = repair_country_currency(df)
    df = lower_text(df)
    df = add_durations(df)
    df = add_text(df)
    df = df.filter(F.col("goal") > 0)
    df = fill_missing(df)
    return keep_labels(df)


def prepare_file(spark, csv_path: str, out_path: str, schema=None, lossless: bool = False):
    """Raw campaign CSV (header, null token ``false``) → prepared Parquet.
    ``lossless`` reads cells with quotes and line breaks, one task per file.

    The reader applies the null token, so ``prepare`` does not apply it again;
    the whole job is one narrow scan → project → filter → write plan.
    Returns the path written.
    """
    from fundcast.sinks import write_parquet
    from fundcast.sources import read_campaign_csv

    return write_parquet(prepare(read_campaign_csv(spark, csv_path, schema=schema, lossless=lossless), None), out_path)

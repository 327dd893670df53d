"""CSV quote repair: raw lines → collapse doubled-quote runs → text → CSV.

Lines whose quotes were doubled by a bad export parse as CSV again once every
run of two or more ``"`` is replaced by a space. Every step is narrow (no
shuffle); the intermediate text goes to the given path, which must not exist.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundcast.functions import quote_runs_to_space
from fundcast.sinks import write_text
from fundcast.sources import read_lines, read_plain_csv


def repair_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.select(quote_runs_to_space(F.col(column)).alias("replaced"))


def repair_csv_file(spark: SparkSession, src_path: str, clean_path: str) -> DataFrame:
    """Read ``src_path`` as lines, repair, write to ``clean_path``, read it as
    header-less CSV (string columns ``_c0 …``)."""
    write_text(repair_lines(read_lines(spark, src_path)), "replaced", clean_path)
    return read_plain_csv(spark, clean_path)

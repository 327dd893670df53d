"""Word and token tables over text columns.

Everything stays in Catalyst: ``explode`` of built-in splits feeds a grouped
count whose partial aggregation collapses every word to one row per task
before the shuffle, so a word holding a third of all occurrences costs no
more shuffle than a rare one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundcast.functions import split_lines, split_on_space


def lines(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per line of every text cell (column ``value``)."""
    return df.select(F.explode(split_lines(F.col(text_col))).alias("value"))


def words(lines_df: DataFrame, column: str = "value") -> DataFrame:
    """One row per space-separated word (Java ``split(" ")`` semantics)."""
    return lines_df.select(F.explode(split_on_space(F.col(column))).alias("word"))


def word_count(lines_df: DataFrame, column: str = "value") -> DataFrame:
    """(word, count) over all lines; map-side combined, one shuffle."""
    return words(lines_df, column).groupBy("word").count()


def top_words(counts: DataFrame, n: int = 20) -> DataFrame:
    """Most frequent words, ties alphabetical."""
    return counts.orderBy(F.desc("count"), F.asc("word")).limit(n)


def long_tokens(df: DataFrame, id_col: str, array_col: str, out: str = "token") -> DataFrame:
    """(id, pos, token) — an array column in long form, 0-based positions."""
    # outer: for a plain explode the planner adds a test of the array, and tokenises for it again
    return df.select(id_col, F.posexplode_outer(array_col).alias("pos", out)).where("pos is not null")

"""Word count of text files: lines → words (split on single spaces) →
counts, ordered by count. One shuffle, after map-side combining."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundcast.operators.rank import global_rank
from fundcast.operators.text import top_words, word_count
from fundcast.sources import read_lines


def word_count_file(spark: SparkSession, path: str) -> DataFrame:
    return word_count(read_lines(spark, path))


def top_words_file(spark: SparkSession, path: str, n: int = 20) -> DataFrame:
    return top_words(word_count_file(spark, path), n)


def ordered_word_count_file(spark: SparkSession, path: str) -> DataFrame:
    """(word, count, rank): all words by falling count, then by word, ranked over the
    cluster."""
    return global_rank(word_count_file(spark, path), [F.desc("count"), F.asc("word")])

"""Words as column expressions: runs of characters other than space and \\t..\\r."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_BREAKS = "\t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Array of the words of ``text``; null and empty texts give an empty array."""
    spaced = F.translate(F.coalesce(text, F.lit("")), _BREAKS, " " * len(_BREAKS))
    return F.array_remove(F.split(spaced, " "), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def without_spaces(text: Column) -> Column:
    """``text`` without the characters that separate words."""
    return F.translate(F.coalesce(text, F.lit("")), " " + _BREAKS, "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row: inside the lambda it
    is a bound variable, so a use in a nested lambda does not compute it again."""
    return F.transform(F.array(value), body)[0]

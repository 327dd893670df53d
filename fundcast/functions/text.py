"""String expressions for word count, quote repair and text features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundcast.functions._col import as_col

# Line breaks recognised when a text cell is read as lines (\r\n, \n or \r).
LINE_BREAK = r"\r\n|\n|\r"


def split_lines(c: Column | str) -> Column:
    """Split a text cell into lines the way a line reader splits a file:
    empty lines inside are kept, a final line break ends the last line
    instead of starting an empty one, and an empty text has no lines."""
    v = as_col(c)
    parts = F.split(v, LINE_BREAK, -1)
    return (
        F.when(v == "", F.array().cast("array<string>"))
        .when(v.rlike(f"({LINE_BREAK})\\z"), F.slice(parts, 1, F.size(parts) - 1))
        .otherwise(parts)
    )


def split_on_space(c: Column | str) -> Column:
    """Split on single spaces with ``java.lang.String.split(" ")`` semantics.

    Leading and inner empty strings are kept, trailing ones removed; an empty
    input gives ``[""]`` and an all-space input gives ``[]``. Spark's ``split``
    keeps trailing empties, so strip trailing spaces first.
    """
    v = as_col(c)
    return (
        F.when(v == "", F.array(F.lit("")))
        .when(F.rtrim(v) == "", F.array().cast("array<string>"))
        .otherwise(F.split(F.rtrim(v), " ", -1))
    )


def quote_runs_to_space(c: Column | str) -> Column:
    """Replace every run of two or more double quotes by one space."""
    return F.regexp_replace(as_col(c), '"{2,}', " ")


def join_text(*cols: Column | str, sep: str = " ") -> Column:
    """Join strings with ``sep`` skipping nulls; all-null gives ``''``."""
    return F.concat_ws(sep, *[as_col(c) for c in cols])

"""Casts with the lenient semantics of the original jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundcast.functions._col import as_col


INT_PATTERN = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)\z"


def lenient_int(c: Column | str) -> Column:
    """Cast to INT where a bad value becomes null instead of failing.

    For text and whole-number columns. With ANSI mode on, ``CAST('abc' AS INT)``
    raises and ``TRY_CAST('100.5' AS INT)`` is null, while the jobs were written
    for the old lenient cast: a sign, digits and a decimal part, which is cut off
    (``'100.5'`` → 100). Everything else is null: ``'abc'``, ``'1e3'``, ``'12d'``,
    blanks around a number (``' 12 '``), values beyond the int range.
    """
    c = as_col(c)
    return F.when(c.cast("string").rlike(INT_PATTERN), c.try_cast("double").try_cast("int"))


def null_token(c: Column | str, token: str = "false") -> Column:
    """Null a string cell equal to ``token`` (case-sensitive), like the CSV
    reader's ``nullValue`` option does for data that is already loaded."""
    return F.nullif(as_col(c), F.lit(token))

"""Epoch-second arithmetic. Results depend on the session time zone; the
plans pin it to UTC (``fundcast.session.use_utc``) before building."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundcast.functions._col import as_col


def epoch_to_text(c: Column | str) -> Column:
    """Epoch seconds → ``yyyy-MM-dd HH:mm:ss`` string in the session zone."""
    return F.from_unixtime(as_col(c))


def calendar_days(end: Column | str, start: Column | str) -> Column:
    """Whole calendar days from ``start`` to ``end`` (date parts only)."""
    return F.datediff(as_col(end), as_col(start))


def hours_between(later: Column | str, earlier: Column | str, scale: int = 3) -> Column:
    """``(later - earlier) / 3600`` rounded half up to ``scale`` decimals.

    The difference is taken in BIGINT so that far-apart INT epochs cannot
    overflow under ANSI arithmetic.
    """
    diff = as_col(later).cast("long") - as_col(earlier).cast("long")
    return F.round(diff / F.lit(3600.0), scale)

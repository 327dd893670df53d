"""Country / currency repair.

When a row is shifted the country is missing and its code sits in the
currency column. Both repairs are plain expressions, so Catalyst can fold,
push and code-generate them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundcast.functions._col import as_col


def repair_country(country: Column | str, currency: Column | str) -> Column:
    """Null country → take the currency value."""
    return F.coalesce(as_col(country), as_col(currency))


def repair_currency(currency: Column | str) -> Column:
    """A currency whose length is not 3 becomes null; null stays null."""
    cur = as_col(currency)
    return F.when(F.length(cur) == 3, cur)

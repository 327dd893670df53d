"""Array expressions that work within a row, so nothing is shuffled for them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundcast.functions._col import as_col


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row: a use in a nested lambda
    reads a bound variable instead of computing it again."""
    return F.transform(F.array(value), body)[0]


def run_lengths(c: Column | str, item: str = "term", count: str = "tf") -> Column:
    """The distinct items of an array with their counts, as array<struct<item, count>>
    in the items' order: the array is sorted and its runs are measured. Null items are
    left out; a null array gives null."""

    def runs(s: Column) -> Column:
        heads = F.filter(
            F.transform(s, lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
            lambda e: (e["i"] == 0) | (e["x"] != F.get(s, e["i"] - 1)),
        )
        return bound(heads, lambda h: F.transform(
            h, lambda e, k: F.struct(
                e["x"].alias(item), (F.coalesce(F.get(h, k + 1)["i"], F.size(s)) - e["i"]).cast("long").alias(count)
            )
        ))

    return bound(F.sort_array(F.array_compact(as_col(c))), runs)  # array_sort would evaluate a comparator

"""Exact ranks over a whole table, without gathering it in one task.

Rows are ranged and sorted over the cluster; a row's rank is its place in its range
plus the rows of the ranges before, a running sum over one number per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundcast.session import cut_lineage

_PLACE_BITS = 33  # of monotonically_increasing_id: the place in a partition; above it the partition


def global_rank(df: DataFrame, order: list[Column], name: str = "rank", partitions: int | None = None) -> DataFrame:
    """``df`` with its 0-based rank by ``order``. Rows that ``order`` does not tell
    apart get neighbouring ranks in any order; make it total for a repeatable answer."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # written: the ranges must not be drawn anew between the two uses
    placed = cut_lineage(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", _PLACE_BITS).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    # one row per range
    return placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn(
        name, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    ).drop("_at", "_part", "_before")

"""Mixing sources to target weights (native expressions only).

Every document gets a hash-random key. Documents are ranged by that key within
their source, distributed prefix sums of token counts are taken in two levels
(key ranges, then rows within a range), and each source is cut at its exact
budget; a budget above the source's size repeats it in whole epochs first.

Edge cases: a null text has size 0 and is never taken; a null source is a
source of its own and comes last; repeated rows are separate documents; an
empty table gives an empty result; other columns (clashing names included) are
left out, except those named in ``keep``. Ties in the key are broken by
``doc_id`` and then by size, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundcast.llm.words import n_words
from fundcast.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_EPOCHS = 2.0
#: Documents that one key range of a source holds on average, at most.
RANGE_ROWS = 2_000


def sized(docs: DataFrame, text: str = "text", seed: int = 17) -> DataFrame:
    """doc_id, source, size (words) and the random key ``u``; the only pass over the texts."""
    return docs.select(
        "doc_id", F.col("source").alias("source"), n_words(F.col(text)).alias("size"),
        F.xxhash64(F.col("doc_id"), F.lit(seed)).alias("u"),
    )


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
) -> DataFrame:
    """One row per source: source_size, n_docs, weight, target.

    Sources in code-point order (null last) take the weights in turn. They share
    ``share`` of all words by weight; no target exceeds ``max_epochs`` times its
    source's size, and what is cut off there is shared again among the others.
    That settles at target = min(cap, level * weight), where the level follows
    from prefix sums over the sources in order of cap / weight. The windows run
    over one row per source, not over documents.
    """
    per = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs")
    )
    everything = Window.partitionBy(F.lit(0))
    in_order = everything.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(
        F.array(*[F.lit(float(x)) for x in weights]),
        ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int"),
    )
    per = per.withColumn("weight", w).withColumn("cap", max_epochs * F.col("source_size"))
    filled = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # the level if this source is the first that its cap does not bind
    levelled = per.withColumn("_level", left / weight_left).withColumn(
        "_free", F.col("_level") * F.col("weight") <= F.col("cap")
    )
    level = F.min(F.when(F.col("_free"), F.struct(F.col("cap") / F.col("weight"), F.col("_level"))))
    return levelled.withColumn("_at", level.over(everything)["_level"]).select(
        "source", "source_size", "n_docs", "weight",
        F.least(F.col("cap"), F.coalesce(F.col("_at") * F.col("weight"), F.col("cap"))).alias("target"),
    )


def mix(
    docs: DataFrame, text: str = "text", weights: Sequence[float] = WEIGHTS, share: float = SHARE,
    max_epochs: float = MAX_EPOCHS, whole: bool = False, seed: int = 17,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    ``taken`` counts the document's words in the mix, repeats included. The
    document in which a source's budget ends is cut there, so that the source's
    words equal its rounded target; with ``whole`` it is taken whole if at least
    half of it lies within the budget, else not at all.
    """
    thin = cut_lineage(sized(docs, text, seed), "mix-sizes")  # texts are read once
    goal = targets(thin, weights, share, max_epochs)
    ranges = F.greatest(F.ceil(F.col("n_docs") / RANGE_ROWS), F.lit(1))
    placed = thin.join(
        goal.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left"
    ).drop("_source").withColumn("range", F.floor(  # key ranges of equal width, ascending in u
        (F.col("u").cast("double") / F.lit(2.0**64) + 0.5) * ranges
    ))
    by_range = Window.partitionBy("source").orderBy("range")
    offsets = placed.groupBy("source", "range").agg(F.sum("size").alias("_sum")).select(
        F.col("source").alias("_source"), F.col("range").alias("_range"),
        (F.sum("_sum").over(by_range) - F.col("_sum")).alias("_before"),
    )
    within = Window.partitionBy("source", "range").orderBy("u", "doc_id", "size")
    summed = placed.withColumn(
        "_in", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    ).join(
        offsets,
        F.col("source").eqNullSafe(F.col("_source")) & (F.col("range") == F.col("_range")), "left",
    )
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size") - (F.col("_before") + F.col("_in"))
    last = F.least(F.greatest(rest, F.lit(0)), F.col("size"))
    if whole:
        last = F.when(2 * last >= F.col("size"), F.col("size")).otherwise(F.lit(0))
    return summed.select(
        "doc_id", "source", "size", "source_size", "target",
        (epochs * F.col("size") + last).cast("long").alias("taken"),
    )


def repeated(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every document as many times as the mix takes it, whole. Rows
    that repeat a doc_id are taken alike, by the rounded mean over those rows."""
    taken = mix(docs, whole=True, **options).groupBy(F.col("doc_id").alias("_id")).agg(
        F.round(F.avg(F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0))).cast("int").alias("_times")
    ).where("_times > 0")
    return docs.join(taken, F.col("doc_id").eqNullSafe(F.col("_id"))).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))
    ).select(*docs.columns)

"""Hard negatives: for anchors and their nearest rows of the same label, the nearest
rows of other labels whose score lies in a window below the positive's.

Rows are integer vectors; a row's score is its inner product with the anchor, higher
first, ties by smaller id. They are ranged over the cluster by label and nearest pivot
(one of ``PIVOTS`` rows by hash order, only for locality), and every range becomes one
cover tree (``cover_tree``). Anchors come in blocks of a bounded size; each block is
sent to the trees twice, first for the positives, then for the negatives of their
windows, and the best of all trees are merged. Every row is searched: nothing is
sampled, and covering radii alone decide what is skipped.

Work grows as anchors times rows at worst (in many dimensions radii skip little); the
rows are read once for each block of anchors, never shuffled again.

Edge cases: rows with a null id, label or vector, or with a null or non-finite
component, take no part; neither do vectors of norm 2**31 or more, whose scores have
no long. Shorter vectors are taken as zero beyond their end. Rows that repeat id, label
and vector are one; rows that share an id otherwise are rows of their own. An anchor
without a positive, or a positive without a row in its window (a negative score has
none), gives no rows. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundcast.llm import cover_tree, packed
from fundcast.llm.cover_tree import LOW, Best
from fundcast.session import cut_lineage, scratch_path

PIVOTS = 64
#: Components in one tree, and in one block of anchors, about.
TREE_COMPONENTS = 1 << 19
ANCHOR_COMPONENTS = 1 << 21
#: Queries that are searched together.
TOGETHER = 256


def prepared(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(id, label, vector array<long>) of the rows that take part, components scaled
    and rounded down."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale))
    inf = float("inf")
    usable = F.forall("embedding", lambda c: c.isNotNull() & (c.cast("double") > -inf) & (c.cast("double") < inf))
    square = F.aggregate(
        "embedding", F.lit(0.0), lambda s, c: s + F.pow(c.cast("double") * scale, F.lit(2.0)) + F.abs(c.cast("double")) * 2 * scale + 1
    )
    return vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable & (square < 2.0**62)).select(
        F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), x.alias("vector")
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of one width, zeros beyond their ends."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = np.asarray(pa.compute.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    out = np.zeros((len(n), width), np.int64)
    out[np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = column.flatten().to_numpy()
    return out


_TREE = "ids binary, labels binary, vectors binary, centers binary, radius binary, children binary, points binary, norm double"


def _plant(width: int):
    """One tree of all rows of a task, which come sorted by label, pivot and id."""

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        ids, labels = t.column("id").to_numpy(), t.column("label").to_numpy()
        x = _matrix(t.column("vector"), width)
        order = np.lexsort((*x.T[::-1], labels, ids))
        ids, labels, x = ids[order], labels[order], x[order]
        new = (ids[1:] != ids[:-1]) | (labels[1:] != labels[:-1]) | (x[1:] != x[:-1]).any(axis=1)
        one = np.concatenate([[True], new])
        ids, labels, x = ids[one], labels[one], x[one]
        tree = cover_tree.build(x)
        o = tree.order
        parts = (ids[o], labels[o], x[o], tree.centers, tree.radius, tree.children, tree.points)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p.tobytes()], pa.binary()) for p in parts] + [pa.array([tree.norm])],
            names=[c.split(" ")[0] for c in _TREE.split(", ")],
        )

    return plant


def planted(rows: DataFrame) -> tuple[DataFrame, int]:
    """The cover trees of all rows as a written table, and the width of the vectors."""
    spark = rows.sparkSession
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width")).first()
    width = max(size.width, 1)
    pivots = rows.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).select("vector").toArrow()
    pivot = _matrix(pivots.column("vector"), width).astype(np.float64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"), width).astype(np.float64)
            near = ((pivot * pivot).sum(axis=1) - 2 * x @ pivot.T).argmin(axis=1)
            yield batch.append_column("pivot", pa.array(near, pa.int64()))

    trees = max(1, -(-size.n * width // TREE_COMPONENTS))
    ranged = rows.mapInArrow(place, "id long, label long, vector array<long>, pivot long").repartitionByRange(
        trees, "label", "pivot", F.xxhash64("id"), "id"
    )
    return cut_lineage(ranged.drop("pivot").mapInArrow(_plant(width), _TREE), "cover-trees"), width


def _tree(batch: pa.RecordBatch, row: int, width: int):
    def part(name, kind, *shape):
        return np.frombuffer(batch.column(name)[row].as_py(), kind).reshape(*shape)

    x = part("vectors", np.int64, -1, width)
    tree = cover_tree.Tree(
        np.arange(len(x)), part("centers", np.float64, -1, width), part("radius", np.float64, -1),
        part("children", np.int64, -1, 2), part("points", np.int64, -1, 2), batch.column("norm")[row].as_py(),
    )
    return tree, x, part("ids", np.int64, -1), part("labels", np.int64, -1)


_FOUND = "query int, score long, id long"


def _searched(trees: DataFrame, width: int, queries, k: int) -> DataFrame:
    """(query, score, id): each task's ``k`` best for every query. ``queries`` is a
    broadcast of (vectors, of, ids, labels, least, most, same): query i has the vector
    ``of[i]``; ``same`` says whether rows of its label count, or all others."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, of, names, labels, least, most, same = queries.value
        best = Best(len(of), k)
        square = (vectors.astype(np.float64) ** 2).sum(axis=1)
        for batch in batches:
            for row in range(batch.num_rows):
                tree, x, ids, label = _tree(batch, row, width)
                norm = (x.astype(np.float64) ** 2).sum(axis=1)
                own = np.unique(label)
                # positives are in trees with the label, negatives in those with another
                ask = np.flatnonzero(np.isin(labels[of], own) if same else (len(own) > 1) | (labels[of] != own[0]))
                for at in np.split(ask, range(TOGETHER, len(ask), TOGETHER)):
                    v = of[at]

                    def fits(rows, leaf, v=v):
                        equal = labels[v[rows]][:, None] == label[leaf]
                        if not same:
                            return ~equal
                        mine = (names[v[rows]][:, None] == ids[leaf]) & (square[v[rows]][:, None] == norm[leaf])
                        if mine.any():  # the anchor itself: same id, label and vector
                            for i, j in zip(*np.nonzero(mine & equal)):
                                equal[i, j] = (vectors[v[rows[i]]] != x[leaf][j]).any()
                        return equal

                    cover_tree.search(tree, x, ids, vectors[v], least[at], most[at], fits, best, at)
        query, place = np.nonzero(best.score > LOW)
        yield pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int32()), pa.array(best.score[query, place]), pa.array(best.id[query, place])],
            names=["query", "score", "id"],
        )

    # a task's lists are merged here; there are k rows for each task and query at most
    with packed.small_batches(trees.sparkSession, 1):
        found = cut_lineage(trees.mapInArrow(search, _FOUND), "found")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def mine(
    rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90)
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the
    rows (id, label, vector) that ``anchor`` holds for; a negative's score is from
    ``window[0]`` to ``window[1]`` percent of the positive's."""
    spark = rows.sparkSession
    trees, width = planted(rows)
    chosen = rows.where(anchor).dropDuplicates(["id", "label", "vector"])
    blocks = max(1, -(-chosen.count() * width // ANCHOR_COMPONENTS))
    chosen = cut_lineage(chosen.withColumn("block", F.expr(f"pmod(xxhash64(id, vector), {blocks})")), "anchors")
    out = scratch_path(spark, "negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(out)
    for block in range(blocks):
        t = chosen.where(F.col("block") == block).drop("block").toArrow()  # bounded: a block of anchors
        if not t.num_rows:
            continue
        vectors = _matrix(t.column("vector"), width)
        names, labels = t.column("id").to_numpy(), t.column("label").to_numpy()
        n = len(names)
        low, high = np.full(n, LOW + 1), np.full(n, -LOW)
        sent = spark.sparkContext.broadcast((vectors, np.arange(n), names, labels, low, high, True))
        near = _searched(trees, width, sent, positives).orderBy("query", "place").toArrow()  # bounded likewise
        sent.destroy()
        of, score = near.column("query").to_numpy().astype(np.int64), near.column("score").to_numpy()
        least = np.array([-(-window[0] * s // 100) for s in score.tolist()], np.int64)
        most = np.array([window[1] * s // 100 for s in score.tolist()], np.int64)
        ask = np.flatnonzero(least <= most)
        if not len(ask):
            continue
        sent = spark.sparkContext.broadcast((vectors, of[ask], names, labels, least[ask], most[ask], False))
        pairs = spark.createDataFrame(
            pa.table({
                "query": pa.array(np.arange(len(ask)), pa.int32()), "anchor_id": pa.array(names[of[ask]]),
                "positive_id": pa.array(near.column("id").to_numpy()[ask]), "positive_score": pa.array(score[ask]),
            })
        )
        found = _searched(trees, width, sent, negatives)
        found.join(pairs, "query").select(
            "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(out)
        sent.destroy()
    return spark.read.schema(schema).parquet(out)

"""Fitted trees as tables: nodes read from a saved model, rows routed to leaves by joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundcast.operators.learn import LABEL
from fundcast.operators.sizing import broadcast_if_within
from fundcast.operators.vectors import entry

#: About the bytes of a node in memory.
NODE_BYTES = 200


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """(tree, node, left, right, feature, threshold, categories, prediction, stats,
    weight) of a model saved at ``path``: a tree, a forest or boosted trees. Leaves have
    no children; ``categories`` (that go left) stand in place of a threshold where the
    feature is categorical; ``weight`` is the tree's."""
    nodes = spark.read.parquet(f"{path}/data")
    if "treeID" in nodes.columns:
        trees = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
        nodes = nodes.select(F.col("treeID").alias("tree"), "nodeData.*").join(F.broadcast(trees), "tree")
    else:
        nodes = nodes.withColumns({"tree": F.lit(0), "weight": F.lit(1.0)})
    inner, values = F.col("leftChild") >= 0, F.col("split.leftCategoriesOrThreshold")
    continuous = F.col("split.numCategories") < 0
    return nodes.select(
        "tree", F.col("id").alias("node"), F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"), F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & continuous, F.get(values, F.lit(0))).alias("threshold"),
        F.when(inner & ~continuous, values).alias("categories"), "prediction", F.col("impurityStats").alias("stats"), "weight",
    )


def goes_left(value: Column) -> Column:
    return F.when(F.col("categories").isNull(), value <= F.col("threshold")).otherwise(
        F.array_contains("categories", value)
    )


def asked_entries(parts: Column, used: list[int]) -> Column:
    """The stored entries of a sparse vector's parts at the indices ``used``."""
    return F.filter(F.arrays_zip(parts["indices"].alias("index"), parts["values"].alias("value")), lambda e: e["index"].isin(used))


def asked(parts: Column, found: Column) -> Column:
    """A vector's parts with the entries ``found`` alone if it is sparse, whole if dense."""
    sparse = parts["type"] == 0
    return F.struct(
        parts["type"].alias("type"), parts["size"].alias("size"),
        F.when(sparse, found["index"]).otherwise(parts["indices"]).alias("indices"),
        F.when(sparse, found["value"]).otherwise(parts["values"]).alias("values"),
    )


def route(rows: DataFrame, nodes: DataFrame, trees: int, depth: int, features: str = "features") -> DataFrame:
    """``rows`` (with a vector's parts in ``features``, see ``vectors``) once for each of
    ``trees`` trees, with ``tree`` and the ``leaf`` that holds them, after at most
    ``depth`` steps. A step is a join with the nodes, which are broadcast within the
    session's limit."""
    nodes = nodes.select("tree", "node", "left", "right", "feature", "threshold", "categories")
    used = [r["feature"] for r in nodes.select("feature").where("feature IS NOT NULL").distinct().collect()]
    nodes = broadcast_if_within(nodes, NODE_BYTES * nodes.count())
    # what the nodes ask for, taken once per row: every tree and step copies and searches it
    at = rows.withColumn("_e", asked_entries(F.col(features), used)).withColumn("_asked", asked(F.col(features), F.col("_e")))
    at = at.withColumn("tree", F.explode(F.array(*[F.lit(t) for t in range(trees)]))).withColumn("node", F.lit(0))
    kept = [*rows.columns, "_asked", "tree"]
    for _ in range(depth):
        value = entry(F.col("_asked"), F.col("feature"))
        below = F.when(F.col("left").isNull(), F.col("node")).when(goes_left(value), F.col("left")).otherwise(F.col("right"))
        at = at.join(nodes, ["tree", "node"]).select(*kept, below.alias("node"))
    return at.select(*rows.columns, "tree", F.col("node").alias("leaf"))


def leaf_counts(routed: DataFrame, label: str = LABEL) -> DataFrame:
    """(tree, leaf, negatives, positives) of the rows in every leaf that has some."""
    one = F.col(label) == 1
    return routed.groupBy("tree", "leaf").agg(
        F.count(F.when(~one, 1)).cast("double").alias("negatives"), F.count(F.when(one, 1)).cast("double").alias("positives")
    )


def differing_leaves(routed: DataFrame, nodes: DataFrame, label: str = LABEL) -> DataFrame:
    """Leaves whose stored label counts are not those of ``routed``, the training rows
    of a single tree."""
    stored = nodes.where("left IS NULL").select(
        "tree", F.col("node").alias("leaf"), F.get("stats", F.lit(0)).alias("n"), F.get("stats", F.lit(1)).alias("p")
    )
    return stored.join(leaf_counts(routed, label), ["tree", "leaf"], "full").where(
        ~(F.col("n").eqNullSafe(F.col("negatives")) & F.col("p").eqNullSafe(F.col("positives")))
    )


def raw_scores(routed: DataFrame, nodes: DataFrame, key: str, boosted: bool, single: bool = False) -> DataFrame:
    """(key, raw0, raw1): what the trees say of every row, as their model does. A single
    tree gives its leaf's label counts, a forest the sum of its leaves' label shares,
    boosted trees the weighted sum of their predictions, negative and positive."""
    leaves = nodes.select("tree", F.col("node").alias("leaf"), "prediction", "stats", "weight")
    said = routed.select(key, "tree", "leaf").join(broadcast_if_within(leaves, NODE_BYTES * leaves.count()), ["tree", "leaf"])
    if boosted:
        margin = F.sum(F.col("prediction") * F.col("weight"))
        return said.groupBy(key).agg((-margin).alias("raw0"), margin.alias("raw1"))
    n, p = F.get("stats", F.lit(0)), F.get("stats", F.lit(1))
    total = F.lit(1.0) if single else n + p
    return said.groupBy(key).agg(F.sum(n / total).alias("raw0"), F.sum(p / total).alias("raw1"))

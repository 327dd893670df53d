"""Classifiers, grids, splits and model inspection with the original settings."""

from __future__ import annotations

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

LABEL = "final_status"
PREDICTION = "predictions"
SEED = 12345
# Fixed values of the original search.
REG_PARAMS = (1e-7, 1e-5, 1e-3, 1e-1)
MIN_DFS = (55.0, 75.0, 95.0)
THRESHOLDS = (0.7, 0.3)


def logistic_regression(max_iter: int = 300, reg_param: float = 0.0, raw_col: str = "rawPrediction") -> LogisticRegression:
    """L2 logistic regression; thresholds [0.7, 0.3] predict class 1 as soon
    as its probability exceeds 0.3."""
    return LogisticRegression(
        featuresCol="features", labelCol=LABEL, predictionCol=PREDICTION, rawPredictionCol=raw_col,
        elasticNetParam=0.0, fitIntercept=True, standardization=True, thresholds=list(THRESHOLDS),
        tol=1e-6, maxIter=max_iter, regParam=reg_param,
    )


# For deep trees or long boosting runs on large data, pass these to the tree
# learners: each instance's node id is cached instead of the trees being
# shipped to the executors on every pass, and that state is checkpointed every
# 10 iterations so lineage stays short. Neither changes the fitted model
# (tested). Off by default: for the default depth-5 trees they cost more than
# they save (measured 25-50 % slower at the bench scale).
DEEP_TREE_SCALE = {"cacheNodeIds": True, "checkpointInterval": 10}


def gradient_boosted_trees(max_iter: int = 10, seed: int = SEED, **scale) -> GBTClassifier:
    return GBTClassifier(
        featuresCol="features", labelCol=LABEL, predictionCol=PREDICTION, maxIter=max_iter, seed=seed,
        **scale,
    )


def random_forest(num_trees: int = 10, seed: int = SEED, **scale) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol="features", labelCol=LABEL, predictionCol=PREDICTION, numTrees=num_trees, seed=seed,
        **scale,
    )


def decision_tree(seed: int = SEED, **scale) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(
        featuresCol="features", labelCol=LABEL, predictionCol=PREDICTION, seed=seed, **scale
    )


CLASSIFIERS = {
    "logreg": logistic_regression,
    "gbt": gradient_boosted_trees,
    "forest": random_forest,
    "tree": decision_tree,
}


ELASTIC_NETS = (0.0, 0.3, 0.5, 0.8, 1.0)


def param_grid(lr: LogisticRegression, cv, reg_params=REG_PARAMS, min_dfs=MIN_DFS, elastic_nets=None):
    """Cross product of the given dimensions: regParam × minDF (12 points
    with the original values); pass ``None`` to leave a dimension out (the
    regParam-only and minDF-only variants) or ``elastic_nets`` to add the
    elastic-net mixing dimension."""
    builder = ParamGridBuilder()
    if reg_params:
        builder = builder.addGrid(lr.regParam, list(reg_params))
    if min_dfs:
        builder = builder.addGrid(cv.minDF, list(min_dfs))
    if elastic_nets:
        builder = builder.addGrid(lr.elasticNetParam, list(elastic_nets))
    return builder.build()


def grid_table(spark: SparkSession, grid, metrics=None) -> DataFrame:
    """One row per grid point: its parameters as text, plus its metric."""
    rows = []
    for i, point in enumerate(grid):
        params = {p.name: v for p, v in point.items()}
        m = None if metrics is None else float(metrics[i])
        rows.append((i, params.get("regParam"), params.get("minDF"), params.get("elasticNetParam"), m))
    return spark.createDataFrame(rows, "point INT, regParam DOUBLE, minDF DOUBLE, elasticNetParam DOUBLE, f1 DOUBLE")


def random_split(df: DataFrame, weights=(0.9, 0.1), seed: int = SEED, materialise: bool = True):
    """Bernoulli split by Spark's sampler.

    Each part re-reads the input, and the sampler's answer depends on the
    input's partitioning and row order. With ``materialise`` the input is
    written once as Parquet (shared checkpoint folder) and both parts read
    that table: the upstream work is not repeated per part, and a part
    recomputed after a lost executor sees the same rows in the same order.
    """
    if materialise:
        from fundcast.session import cut_lineage

        df = cut_lineage(df, "split-input")
    return df.randomSplit(list(weights), seed=seed)


def key_split(df: DataFrame, key: str, train_fraction: float = 0.9, seed: int = SEED):
    """Repeatable split: a row goes to train iff the MD5 of (key, seed) falls below
    ``train_fraction`` of its range; independent of partitioning and order, and
    the same in SQL (``key_split_sql``). A null key counts as an empty one."""
    head = F.substring(F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))).cast("binary")), 1, 7)
    first = head < F.lit(_hex_bound(train_fraction))
    return df.filter(first), df.filter(~first)


def _hex_bound(fraction: float) -> str:
    """Strings of 7 hex digits below this one are ``fraction`` of them."""
    return "g" if fraction >= 1 else format(int(fraction * 16**7), "07x")


def key_split_sql(key: str, train_fraction: float = 0.9, seed: int = SEED) -> str:
    """DuckDB condition that holds for the training rows of ``key_split``."""
    return f"substr(md5(concat_ws('-', CAST({key} AS VARCHAR), '{seed}')), 1, 7) < '{_hex_bound(train_fraction)}'"


def exact_split(df: DataFrame, key: str, train_fraction: float = 0.9, seed: int = SEED):
    """Split with an exact quota: train gets round(``train_fraction`` * rows) rows (halves
    up), those with the smallest MD5 of (key, seed), whatever the partitioning.

    Only the hashes are ranked over the cluster; the rows themselves are compared with
    the hash at the quota and stay where they are. Rows that share it (a repeated key)
    are told apart by a hash of all their columns, and rows alike in all of them fill
    the quota in any order. A null key counts as an empty one."""
    from fundcast.operators.rank import global_rank
    from fundcast.session import cut_lineage

    own = F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    row = F.concat_ws("-", own, F.hex(F.xxhash64(*[F.col(c) for c in df.columns])))
    ranks = global_rank(df.select(row.alias("_h")), [F.asc("_h")])
    n = ranks.count()
    quota = int(train_fraction * n + 0.5)
    if quota <= 0 or quota >= n:
        return (df, df.limit(0)) if quota else (df.limit(0), df)
    last = ranks.where(F.col("rank") == quota - 1).first()["_h"]
    before = ranks.where(F.col("_h") < last).count()
    equal = ranks.where(F.col("_h") == last).count()
    if before + equal == quota:
        return df.where(row <= last), df.where(row > last)
    # copies of one row straddle the quota: any of them, spread as they lie
    copies = cut_lineage(df.where(row == last).withColumn("_copy", F.monotonically_increasing_id()), "copies")
    copies = global_rank(copies, [F.asc("_copy")])
    first = copies.where(F.col("rank") < quota - before).drop("rank", "_copy")
    rest = copies.where(F.col("rank") >= quota - before).drop("rank", "_copy")
    return df.where(row < last).unionAll(first), df.where(row > last).unionAll(rest)


def explain_params(spark: SparkSession, pipeline_model) -> DataFrame:
    """(stage, param, value) for every explicitly set or default param of
    every stage of a fitted pipeline."""
    rows = []
    for stage in pipeline_model.stages:
        for p, v in stage.extractParamMap().items():
            rows.append((type(stage).__name__, p.name, str(v)))
    schema = StructType([StructField(n, StringType()) for n in ("stage", "param", "value")])
    return spark.createDataFrame(rows, schema)

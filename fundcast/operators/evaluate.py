"""Classification quality as DataFrames.

``weighted_f1`` is the class-weighted F1 of ``MulticlassClassificationEvaluator``
written as aggregations: one distributed grouped sum per class (partial-
aggregated), then arithmetic on a table of one row per class.
"""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABEL = "final_status"
PREDICTION = "predictions"


def confusion(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """(label, prediction, count) for every pair that occurs."""
    return df.groupBy(label, prediction).count()


def weighted_f1(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION, digits: int | None = 9) -> DataFrame:
    """One row ``f1``: Σ_class F1(class) · n(class) / Σ n(class) over the classes
    that occur as labels; precision or recall with an empty denominator is 0.

    Every row counts once for its label's class (actual, and true positive
    when the prediction agrees) and once for its predicted class; a single
    grouped sum over these roles gives every class's counts with no join,
    partial-aggregated to one row per class per task before the shuffle.
    """
    l = F.col(label).cast("double")
    p = F.col(prediction).cast("double")
    roles = F.array(
        F.struct(l.alias("c"), F.lit(1).alias("a"), (l == p).cast("int").alias("t"), F.lit(0).alias("q")),
        F.struct(p.alias("c"), F.lit(0).alias("a"), F.lit(0).alias("t"), F.lit(1).alias("q")),
    )
    stats = (
        df.select(F.inline(roles))
        .groupBy("c")
        .agg(F.sum("a").alias("actual"), F.sum("t").alias("tp"), F.sum("q").alias("predicted"))
        .filter(F.col("actual") > 0)
    )
    precision = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    recall = F.col("tp") / F.col("actual")
    f1 = F.when(precision + recall == 0, F.lit(0.0)).otherwise(2.0 * precision * recall / (precision + recall))
    weighted = stats.agg((F.sum(f1 * F.col("actual")) / F.sum("actual")).alias("f1"))
    if digits is not None:
        weighted = weighted.select(F.round("f1", digits).alias("f1"))
    return weighted


def f1_evaluator(label: str = LABEL, prediction: str = PREDICTION) -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName="f1")

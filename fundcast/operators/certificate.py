"""Whether a fitted logistic regression is the best one for its training rows.

At the optimum of the L2-penalised loss its gradient is zero. The gradient is one
grouped aggregate over the stored feature entries, with one row per feature: the
residual of a row times its entry, plus the penalty on the coefficient, in the units
in which the fit works (features divided by their standard deviation).
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundcast.operators.learn import LABEL
from fundcast.operators.vectors import entries, written_parts

#: The intercept's place in the gradient.
INTERCEPT = -1


def gradient(model, train: DataFrame, label: str = LABEL) -> DataFrame:
    """(index, gradient) of the training loss at ``model``'s coefficients, a row for
    every feature with an entry and one for the intercept."""
    scored = model.transform(train).select(
        F.col(label).cast("double").alias("y"), F.col(model.getFeaturesCol()).alias("features"),
        vector_to_array(model.getProbabilityCol())[1].alias("p"),
    )
    parts = written_parts(scored, "certificate")
    one = F.array(F.struct(F.lit(INTERCEPT).alias("index"), F.lit(1.0).alias("value")))
    rows = parts.select((F.col("p") - F.col("y")).alias("r"), F.inline(F.concat(one, entries(F.col("features")))))
    sums = rows.groupBy("index").agg(
        F.sum(F.col("r") * F.col("value")).alias("rx"), F.sum("value").alias("x"), F.sum(F.col("value") ** 2).alias("xx")
    )
    n = parts.count()
    spark = train.sparkSession
    weights = spark.createDataFrame(list(enumerate(model.coefficients.toArray().tolist())), "index int, weight double")
    deviation = F.sqrt(F.greatest((F.col("xx") - F.col("x") ** 2 / n) / max(n - 1, 1), F.lit(0.0)))
    unit = F.col("deviation") if model.getStandardization() else F.lit(1.0)
    # a feature without spread has no coefficient; the intercept has no penalty
    slope = F.when(F.col("index") == INTERCEPT, F.col("rx") / n).when(
        F.col("deviation") > 0,
        F.col("rx") / n / F.col("deviation") + model.getRegParam() * F.col("weight") * unit**2 / F.col("deviation"),
    ).otherwise(0.0)
    return sums.join(weights, "index", "left").withColumn("deviation", deviation).select("index", slope.alias("gradient"))


def certificate(model, train: DataFrame, tolerance: float, label: str = LABEL) -> DataFrame:
    """One row: training rows, the largest entry of the gradient, and whether it is
    within ``tolerance`` (for an elastic net without an L1 part)."""
    largest = gradient(model, train, label).agg(F.max(F.abs("gradient")).alias("g")).first()["g"] or 0.0
    return train.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(largest).alias("largest"), F.lit(largest <= tolerance).alias("optimal")
    )

"""Profiling reports."""

from pyspark.sql import functions as F

from fundcast.operators import profile


def test_frequency_and_top_k_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("a",), ("c",)], "k string")
    rows = [tuple(r) for r in profile.frequency(df, "k").collect()]
    assert rows == [("a", 2), ("b", 2), (None, 1), ("c", 1)]
    top = profile.top_k(df, ["k"], 2)
    assert [tuple(r) for r in top.collect()] == [("a", 2), ("b", 2)]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_describe_matches_spark_describe(spark):
    df = spark.createDataFrame([(1, 10), (2, None), (4, 30)], "x int, y int")
    tidy = {r["column"]: r for r in profile.describe_numeric(df, ["x", "y"]).collect()}
    wide = {r["summary"]: r for r in df.describe("x", "y").collect()}
    for c in ("x", "y"):
        assert tidy[c]["count"] == int(wide["count"][c])
        assert abs(tidy[c]["mean"] - float(wide["mean"][c])) < 1e-6
        assert abs(tidy[c]["stddev"] - float(wide["stddev"][c])) < 1e-6
        assert tidy[c]["min"] == float(wide["min"][c]) and tidy[c]["max"] == float(wide["max"][c])


def test_schema_report_and_shape(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    rows = [tuple(r) for r in profile.schema_report(df).collect()]
    assert rows == [(1, "a", "int", 2), (2, "b", "string", 1)]
    assert tuple(profile.shape(df).first()) == (2, 2)


def test_preview_and_distinct(spark):
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    assert [r["id"] for r in profile.preview(df, 3, [F.desc("id")]).collect()] == [9, 8, 7]
    assert sorted(r[0] for r in profile.distinct_values(df, "k").collect()) == [0, 1, 2]


def test_frequencies_one_pass_equals_per_key(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("a", None), (None, 2)], "k string, n int")
    both = {(r["column"], r["value"]): r["count"] for r in profile.frequencies(df, ["k", "n"]).collect()}
    per_key = {}
    for k in ("k", "n"):
        for r in profile.frequency(df, k).collect():
            per_key[(k, None if r[k] is None else str(r[k]))] = r["count"]
    assert both == per_key
    assert both[("k", None)] == 1 and both[("n", "1")] == 2
    plan = profile.frequencies(df, ["k", "n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Expand" in plan

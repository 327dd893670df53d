"""Readers and writers: null token, lossless CSV, DROPMALFORMED, text sink."""

import pytest
from pyspark.errors import AnalysisException

from fundcast.operators.profile import row_count
from fundcast.plans.quote_repair import repair_csv_file
from fundcast.sinks import write_csv, write_parquet, write_text
from fundcast.sources import read_campaign_csv, read_lines, read_parquet, read_plain_csv, read_strict_csv


def test_csv_roundtrip_lossless_and_null_token(spark, tmp_dir):
    rows = [
        (1, "line one\nline two", ' say "hi" ', "false", "true"),
        (2, "", "  padded  ", "False", "false"),
    ]
    df = spark.createDataFrame(rows, "id int, a string, b string, c string, flag string")
    write_csv(df, tmp_dir)
    back = read_campaign_csv(spark, tmp_dir, lossless=True).orderBy("id").collect()
    assert len(back) == 2
    assert back[0]["a"] == "line one\nline two" and back[0]["b"] == ' say "hi" '
    # Only null and "False" remain in c, so inference makes it boolean:
    # "False" is a value (the token is case-sensitive), "false" is null.
    assert back[0]["c"] is None and back[1]["c"] is False
    assert back[0]["flag"] is True and back[1]["flag"] is None
    assert back[1]["b"] == "  padded  "


def test_drop_malformed_and_count_trap(spark, tmp_dir):
    lines = spark.createDataFrame([("a,b,c",), ("1,2,3",), ("4,5",), ("6,7,8,9",), ("x,y,z",)], "value string")
    write_text(lines.coalesce(1), "value", tmp_dir)
    df = read_strict_csv(spark, tmp_dir)
    assert df.columns == ["a", "b", "c"]
    assert len(df.collect()) == 2
    assert row_count(df).first()[0] == 2
    assert df.count() == 2
    assert df.select("a").count() == 2


def test_text_sink_fails_if_present(spark, tmp_dir):
    df = spark.createDataFrame([("x",)], "v string")
    write_text(df, "v", tmp_dir)
    with pytest.raises(AnalysisException):
        write_text(df, "v", tmp_dir)
    assert [r[0] for r in read_lines(spark, tmp_dir).collect()] == ["x"]


def test_quote_repair_job(spark, tmp_dir):
    src = spark.createDataFrame([('1,a""b"""c',), ('2,x""""y',)], "value string")
    write_text(src.coalesce(1), "value", tmp_dir + "/src")
    out = repair_csv_file(spark, tmp_dir + "/src", tmp_dir + "/clean").orderBy("_c0").collect()
    assert [tuple(r) for r in out] == [("1", "a b c"), ("2", "x y")]


def test_plain_csv_has_positional_string_columns(spark, tmp_dir):
    write_text(spark.createDataFrame([("1,2",)], "v string"), "v", tmp_dir)
    df = read_plain_csv(spark, tmp_dir)
    assert df.dtypes == [("_c0", "string"), ("_c1", "string")]


def test_parquet_replace(spark, tmp_dir):
    write_parquet(spark.range(3), tmp_dir)
    write_parquet(spark.range(5), tmp_dir)
    assert read_parquet(spark, tmp_dir).count() == 5



def test_strict_reader_leaves_the_session_alone(spark, tmp_dir):
    before = spark.conf.get("spark.sql.csv.parser.columnPruning.enabled")
    write_text(spark.createDataFrame([("a,b",), ("1,2",)], "v string").coalesce(1), "v", tmp_dir)
    read_strict_csv(spark, tmp_dir).collect()
    assert spark.conf.get("spark.sql.csv.parser.columnPruning.enabled") == before


def test_one_large_csv_file_is_split(spark, tmp_dir):
    write_csv(spark.range(20000).selectExpr("id", "repeat('x', 50) AS t").coalesce(1), tmp_dir)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        df = read_campaign_csv(spark, tmp_dir, schema="id long, t string")
        assert df.rdd.getNumPartitions() > 1
        assert df.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)

"""Plan shapes that matter at scale, and skewed inputs."""

from pyspark.sql import functions as F

from fundcast.operators import features as FT
from fundcast.operators import profile
from fundcast.operators import text as T
from fundcast.operators.sizing import broadcast_if_within, broadcast_limit
from fundcast.operators.vectors import sparse_entries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_vocabulary_join_is_broadcast_when_small(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b"])], "doc_id int, filtered array<string>")
    cv = FT.count_vectorizer(1).fit(df)
    entries = sparse_entries(cv.transform(df), ["doc_id"], "vectorized")
    vocab = FT.vocabulary_table(spark, cv)
    joined = entries.join(vocab, entries["index"] == vocab["idx"])
    p = plan(joined)
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
    assert sorted((r["doc_id"], r["term"], r["value"]) for r in joined.collect()) == [
        (1, "a", 2.0), (1, "b", 1.0), (2, "b", 1.0)
    ]


def test_broadcast_refused_over_limit(spark):
    df = spark.range(3)
    limit = broadcast_limit(spark)
    assert limit > 0
    assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()
    over = broadcast_if_within(df, limit + 1)
    assert over is df
    under = broadcast_if_within(df, 10)
    assert "broadcast" in under._jdf.queryExecution().analyzed().toString().lower()


def test_sparse_entries_read_vectors_as_structs(spark):
    df = spark.createDataFrame([(1, ["a", "b"])], "doc_id int, filtered array<string>")
    cv = FT.count_vectorizer(1).fit(df)
    p = plan(sparse_entries(cv.transform(df), ["doc_id"], "vectorized"))
    assert "json" not in p and "Python" not in p


def test_hot_word_counts_exactly(spark):
    # One word holds a third of all words: partial aggregation keeps the
    # shuffle to one row per task for it, and the count stays exact.
    lines = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot hot hot")).otherwise(F.concat(F.lit("w"), F.col("id").cast("string"))).alias("value")
    )
    counts = T.word_count(lines.repartition(6))
    got = {r["word"]: r["count"] for r in counts.filter(F.col("word") == "hot").collect()}
    assert got == {"hot": 3000}
    assert plan(counts).count("HashAggregate") >= 2


def test_frequency_on_skewed_key(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    top = profile.top_k(df, ["k"], 1).collect()
    assert (top[0]["k"], top[0]["count"]) == ("hot", 3000)


def test_text_reaches_the_tokenizer_without_a_shuffle(spark):
    from fundcast.plans.queries_text import filtered_tokens

    from conftest import SF_SMALL

    assert "Exchange" not in plan(filtered_tokens(spark, SF_SMALL))


def test_weighted_f1_has_no_join(spark):
    from fundcast.operators.evaluate import weighted_f1

    df = spark.createDataFrame([(0, 0.0), (1, 1.0), (1, 0.0)], "final_status int, predictions double")
    p = plan(weighted_f1(df))
    assert "Join" not in p
    assert p.count("Exchange") <= 2


def test_vocabulary_join_falls_back_to_shuffle_when_over_limit(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, ["a"])], "doc_id int, filtered array<string>"
    )
    cv = FT.count_vectorizer(1).fit(df)
    entries = sparse_entries(cv.transform(df), ["doc_id"], "vectorized")

    def joined():
        vocab = FT.vocabulary_table(spark, cv)
        return entries.join(vocab, entries["index"] == vocab["idx"]).select("doc_id", "term", "value")

    small = sorted(tuple(r) for r in joined().collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fallback = joined()
        p = plan(fallback)
        assert "SortMergeJoin" in p and "BroadcastExchange" not in p
        assert sorted(tuple(r) for r in fallback.collect()) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_filters_on_int_columns_reach_the_scan(spark, tmp_dir):
    from fundcast.fixtures import campaign_table
    from fundcast.plans.prepare import prepare
    from fundcast.sinks import write_parquet
    from fundcast.sources import read_parquet

    from conftest import SF_SMALL

    raw = campaign_table(spark, SF_SMALL).withColumn("final_status", F.col("final_status").cast("int"))
    prepared = prepare(read_parquet(spark, write_parquet(raw, tmp_dir)))
    scan = [x for x in plan(prepared).splitlines() if "FileScan" in x][0]
    assert "In(final_status, [0,1])" in scan.split("PushedFilters")[1]
    assert prepared.count() == prepare(raw).count()

"""In-row term counts, distributed ranks, vectors as plain columns."""

import math
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
from pyspark.sql import functions as F

from fundcast.functions.arrays import bound, run_lengths
from fundcast.operators import terms as TM
from fundcast.operators.rank import global_rank
from fundcast.functions.arrays import run_lengths
from fundcast.operators.vectors import entries, entry, read_parts, sparse_entries, sparse_vectors, written_parts

from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(["b", "a", "", "é", "ab", None]), max_size=9)), max_size=8))
@settings(max_examples=25, deadline=None)
def test_run_lengths_count_within_the_row(spark, arrays):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "doc_id int, filtered array<string>")
    got = {r["doc_id"]: r["t"] for r in df.select("doc_id", run_lengths("filtered").alias("t")).collect()}
    for i, a in enumerate(arrays):
        if a is None:
            assert got[i] is None
        else:
            counts = Counter(x for x in a if x is not None)
            assert [(t["term"], t["tf"]) for t in got[i]] == sorted(counts.items(), key=lambda x: x[0].encode())


def test_bound_computes_once(spark):
    df = spark.range(3).select(bound(F.col("id") + 1, lambda x: x * x).alias("y"))
    assert [r["y"] for r in df.collect()] == [1, 4, 9]


def test_term_tables_shuffle_nothing_by_document(spark):
    from fundcast.plans.queries_text import filtered_tokens

    tokens = filtered_tokens(spark, SF_SMALL)
    assert "Exchange" not in plan(TM.term_counts(tokens))
    vocab = plan(TM.document_frequencies(tokens))
    assert vocab.count("Exchange") == 1 and "hashpartitioning(term" in vocab and "doc_id" not in vocab
    assert "Exchange" not in plan(TM.counted(tokens))


def test_document_frequencies_equal_the_vocabulary_of_counts(spark):
    rows = [(1, ["a", "b", "a"]), (2, ["a", "c"]), (3, []), (4, None), (5, ["c", "c"])]
    df = spark.createDataFrame(rows, "doc_id int, filtered array<string>")
    a = sorted(map(tuple, TM.document_frequencies(df, min_df=2).collect()))
    assert a == sorted(map(tuple, TM.vocabulary(TM.term_counts(df), 2).collect())) == [("a", 2), ("c", 2)]


@pytest.mark.parametrize("n,partitions", [(0, 4), (1, 4), (500, 7), (500, 1)])
def test_global_rank_is_row_number(spark, n, partitions):
    rnd = random.Random(n)
    rows = [(rnd.randint(0, 9), rnd.choice("abc"), i) for i in range(n)]
    df = spark.createDataFrame(rows, "x int, y string, i int").repartition(5)
    got = global_rank(df, [F.desc("x"), F.asc("y"), F.asc("i")], "r", partitions).collect()
    want = {i: k for k, (_, _, i) in enumerate(sorted(rows, key=lambda t: (-t[0], t[1], t[2])))}
    assert {r["i"]: r["r"] for r in got} == want


def test_feature_index_of_a_higher_threshold_is_a_prefix(spark):
    vocab = spark.createDataFrame([(t, d) for t, d in zip("zyxwv", (5, 7, 7, 2, 1))], "term string, df long")
    index = {r["term"]: r["index"] for r in TM.feature_index(vocab).collect()}
    assert index == {"x": 0, "y": 1, "z": 2, "w": 3, "v": 4}
    top = {r["term"]: r["index"] for r in TM.feature_index(vocab.where("df >= 5")).collect()}
    assert top == {t: i for t, i in index.items() if i < 3}


def test_vectors_as_parts_and_back(spark):
    rows = [(1, SparseVector(5, {1: 2.0, 4: -1.5})), (2, DenseVector([0.0, 3.0])), (3, SparseVector(4, {})), (4, None)]
    df = spark.createDataFrame(rows, _schema())
    parts = written_parts(df)
    got = {r["id"]: r["e"] for r in parts.select("id", entries(F.col("v")).alias("e")).collect()}
    assert [tuple(e) for e in got[1]] == [(1, 2.0), (4, -1.5)] and [tuple(e) for e in got[2]] == [(0, 0.0), (1, 3.0)]
    assert got[3] == []
    at = {r["id"]: (r["a"], r["b"]) for r in parts.where("id < 4").select(
        "id", entry(F.col("v"), F.lit(1)).alias("a"), entry(F.col("v"), F.lit(4)).alias("b")).collect()}
    assert at == {1: (2.0, -1.5), 2: (3.0, 0.0), 3: (0.0, 0.0)}
    long = sparse_entries(df.where("id < 3"), ["id"], "v")
    vectors = {r["id"]: r["features"] for r in sparse_vectors(long.where("id = 1"), "id", 5).collect()}
    assert vectors == {1: rows[0][1]}


def _schema():
    from pyspark.sql.types import IntegerType, StructField, StructType

    return StructType([StructField("id", IntegerType()), StructField("v", VectorUDT())])


def test_vectors_are_dealt_once_and_their_parts_read_where_they_lie(spark, tmp_dir):
    rows = spark.createDataFrame(
        [(1, 3, 0.5), (1, 0, 1.5), (None, 2, 2.5), (2, 1, 3.5), (1, 3, 0.25), (None, 0, 4.5)],
        "doc_id BIGINT, index INT, value DOUBLE",
    )
    vectors = sparse_vectors(rows, "doc_id", 4, "v", tmp_dir)
    parts = read_parts(spark, tmp_dir, vectors.schema)
    got = {r["doc_id"]: (r["v"]["size"], r["v"]["indices"], r["v"]["values"]) for r in parts.collect()}
    assert got == {1: (4, [0, 3, 3], [1.5, 0.25, 0.5]), 2: (4, [1], [3.5]), None: (4, [0, 2], [4.5, 2.5])}


def test_runs_are_sorted_without_a_comparator(spark):
    df = spark.createDataFrame([(["b", None, "a", "b", "é", "B"],), ([],), (None,)], "t array<string>")
    out = df.select(run_lengths("t").alias("r"))
    assert "array_sort(" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = [None if r["r"] is None else [(x["term"], x["tf"]) for x in r["r"]] for r in out.collect()]
    assert got == [[("B", 1), ("a", 1), ("b", 2), ("é", 1)], [], None]


def test_sparse_tfidf_holds_every_term(spark, tmp_dir):
    from fundcast.plans.queries_text import q_sparse_tfidf

    rare = [(i, " ".join(["common"] * (1 + i % 2) + [f"pair{i // 2}", f"own{i}", "the"])) for i in range(60)]
    rows = rare + [(60, ""), (None, "Common own1")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")
    docs = [(k, Counter(w for w in x.lower().split() if w != "the")) for k, x in rows]
    df = Counter(w for _, c in docs for w in c)
    index = {w: i for i, w in enumerate(sorted(df, key=lambda w: (-df[w], w)))}
    assert [w for w, d in df.items() if d >= 55] == ["common"]
    got = {(r["doc_id"], r["size"], r["index"]): r["value"] for r in q_sparse_tfidf(spark, tmp_dir).collect()}
    assert got == {
        (k, len(df), index[w]): pytest.approx(n * math.log((len(docs) + 1) / (df[w] + 1)), abs=1e-9)
        for k, c in docs for w, n in c.items()
    }

"""Word count, tokenizer, stop words and vector tables."""

from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fundcast.functions.stopwords import ENGLISH_STOP_WORDS
from fundcast.operators import features as FT
from fundcast.operators import terms as TM
from fundcast.operators import text as T
from fundcast.operators.vectors import dense_entries, sparse_entries


def test_word_count_edge_lines(spark):
    lines = spark.createDataFrame([("",), ("   ",), (" a",), ("a  b ",), ("a b   ",)], "value string")
    got = {r["word"]: r["count"] for r in T.word_count(lines).collect()}
    # "" from the empty line, " a" and the double space; "a" three times.
    assert got == {"": 3, "a": 3, "b": 2}


def test_word_count_plan_is_partial_then_final(spark):
    lines = spark.createDataFrame([("a b",)], "value string")
    plan = T.word_count(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2


def test_stop_words_constant_is_spark_default(spark):
    assert tuple(StopWordsRemover.loadDefaultStopWords("english")) == ENGLISH_STOP_WORDS
    assert len(ENGLISH_STOP_WORDS) == 181


def test_tokenizer_equals_sql_form(spark):
    df = spark.createDataFrame([(1, "Café naïve, x_1 THE end!"), (2, "")], "id int, text string")
    ml = {r["id"]: list(r["tokens"]) for r in FT.tokenizer().transform(df).collect()}
    sql = {
        r["id"]: list(r["t"])
        for r in df.select("id", F.expr("filter(split(lower(text), '\\\\W+'), x -> length(x) >= 1)").alias("t")).collect()
    }
    assert ml == sql
    assert ml[1] == ["caf", "na", "ve", "x_1", "the", "end"]


def test_sparse_entries_match_dense(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["c"]), (3, [])], "id int, filtered array<string>")
    cv = FT.count_vectorizer(1).fit(df)
    vec = cv.transform(df)
    sparse = {(r["id"], r["index"]): r["value"] for r in sparse_entries(vec, ["id"], "vectorized").collect()}
    dense = {
        (r["id"], i): v
        for r in vec.select("id", vector_to_array("vectorized").alias("a")).collect()
        for i, v in enumerate(r["a"])
        if v != 0
    }
    assert sparse == dense
    assert len(dense_entries(vec, ["id"], "vectorized").collect()) == 3 * len(cv.vocabulary)


def test_idf_formula(spark):
    import math

    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"]), (3, ["c"])], "id int, filtered array<string>")
    cv = FT.count_vectorizer(1).fit(df)
    m = FT.idf().fit(cv.transform(df))
    got = {r["term"]: r["idf"] for r in FT.idf_table(spark, cv, m).collect()}
    assert abs(got["a"] - math.log(4 / 3)) < 1e-12 and abs(got["c"] - math.log(4 / 2)) < 1e-12
    vocab = {r["term"]: r["df"] for r in FT.vocabulary_table(spark, cv, m).collect()}
    assert vocab == {"a": 2, "b": 1, "c": 1}
    assert FT.term_at(cv, 0) == "a"


def test_term_tables_equal_fitted_stages(spark):
    rows = [(1, ["a", "b", "a"]), (2, ["a", "c"]), (3, ["c", "b", "c"]), (4, []), (5, ["d"])]
    df = spark.createDataFrame(rows, "doc_id int, filtered array<string>")
    cv = FT.count_vectorizer(2).fit(df)
    vec = cv.transform(df)
    weights = FT.idf().fit(vec)
    named = lambda frame, c: {
        (r["doc_id"], cv.vocabulary[r["index"]]): round(r["value"], 12)
        for r in sparse_entries(frame, ["doc_id"], c).collect()
    }
    counts = TM.term_counts(df)
    vocab = TM.vocabulary(counts, 2)
    assert {r["term"]: r["df"] for r in vocab.collect()} == {
        r["term"]: r["df"] for r in FT.vocabulary_table(spark, cv, weights).collect()
    }
    assert {(r["doc_id"], r["term"]): float(r["tf"]) for r in TM.kept_counts(counts, vocab).collect()} == named(vec, "vectorized")
    got = {(r["doc_id"], r["term"]): round(r["weight"], 12) for r in TM.tfidf(counts, vocab, 5).collect()}
    assert got == named(weights.transform(vec), "tfidf")


def test_string_indexer_null_modes(spark):
    import pytest

    df = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "c string")
    keep = FT.indexer("c", "i", "keep").fit(df).transform(df).collect()
    assert [r["i"] for r in keep] == [0.0, 0.0, 1.0, 2.0]
    skip = FT.indexer("c", "i", "skip").fit(df).transform(df).collect()
    assert len(skip) == 3
    with pytest.raises(Exception):
        FT.indexer("c", "i", "error").fit(df).transform(df).collect()


def _python_word_count(texts):
    """Model: split each text like a line reader, each line like
    java.lang.String.split(" "), count the words."""
    import re
    from collections import Counter

    counts = Counter()
    for t in texts:
        if t == "":
            continue
        lines = re.split(r"\r\n|\n|\r", t)
        if re.search(r"(\r\n|\n|\r)\Z", t):
            lines = lines[:-1]
        for line in lines:
            if line == "":
                counts[""] += 1
                continue
            parts = line.split(" ")
            while parts and parts[-1] == "":
                parts.pop()
            counts.update(parts)
    return dict(counts)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\r", max_size=14), min_size=1, max_size=6))
def test_word_count_matches_python_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["word"]: r["count"] for r in T.word_count(T.lines(df, "text")).collect()}
    assert got == _python_word_count(texts)

"""Term tables of tokenised documents, without a vocabulary on the driver.

A document is one row, so its terms are counted in that row (``run_lengths``: its
own token array is sorted and the runs are measured) and nothing is shuffled by
document. Document frequencies, and what is derived from them, are grouped counts
keyed by the term; none is capped. ``feature_index`` numbers the terms by a
distributed rank, so feature vectors need no vocabulary on the driver either. All
tables equal what the fitted ``CountVectorizer`` and ``IDF`` stages hold when their
vocabulary size does not cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundcast.functions.arrays import run_lengths
from fundcast.operators.rank import global_rank

# Fixed value of the original count stage: fewer occurrences in a document are ignored.
MIN_TF = 1


def counted(tokens: DataFrame, key: str = "doc_id", column: str = "filtered") -> DataFrame:
    """(key, terms): the distinct terms of every document with their counts, in its row."""
    terms = run_lengths(column)
    if MIN_TF > 1:
        terms = F.filter(terms, lambda t: t["tf"] >= MIN_TF)
    return tokens.select(key, terms.alias("terms"))


def spread(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, term, tf): one row for every document and term of ``counted``."""
    # outer: for a plain generator the planner adds a test of the array, and computes it for that again
    return documents.select(key, F.inline_outer("terms")).where("term is not null")


def term_counts(tokens: DataFrame, key: str = "doc_id", column: str = "filtered") -> DataFrame:
    """(key, term, tf): occurrences of every term in every document."""
    return spread(counted(tokens, key, column), key)


def document_frequencies(tokens: DataFrame, column: str = "filtered", min_df: int = 1) -> DataFrame:
    """(term, df) of the terms that at least ``min_df`` documents hold, counted from the
    distinct tokens of each row."""
    terms = tokens.select(F.explode_outer(F.array_distinct(column)).alias("term")).where("term is not null")
    return vocabulary(terms, min_df)


def vocabulary(counts: DataFrame, min_df: int = 1) -> DataFrame:
    """(term, df) of the terms that at least ``min_df`` documents hold."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= min_df)


def feature_index(vocab: DataFrame) -> DataFrame:
    """(index, term, df): terms numbered from 0 by falling document frequency, then by
    term, through a distributed rank. The terms of a higher minimum frequency are a
    prefix of it."""
    return global_rank(vocab.select("term", "df"), [F.desc("df"), F.asc("term")], "index").select("index", "term", "df")


def idf(df: str, n_docs: int) -> Column:
    """ln((n + 1) / (df + 1)); ``n_docs`` counts all documents, those without terms included."""
    return F.log((F.lit(n_docs) + 1.0) / (F.col(df) + 1.0)).alias("idf")


def idf_weights(vocab: DataFrame, n_docs: int) -> DataFrame:
    """(term, idf), see ``idf``."""
    return vocab.select("term", idf("df", n_docs))


def kept_counts(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """(key, term, tf) of the terms in ``vocab``."""
    return counts.join(vocab.select("term"), "term", "left_semi")


def tfidf(counts: DataFrame, vocab: DataFrame, n_docs: int, key: str = "doc_id") -> DataFrame:
    """(key, term, weight) with weight = tf * idf."""
    return counts.join(idf_weights(vocab, n_docs), "term").select(key, "term", (F.col("tf") * F.col("idf")).alias("weight"))


def indexed_weights(counts: DataFrame, index: DataFrame, n_docs: int, key: str = "doc_id") -> DataFrame:
    """(key, index, value): TF-IDF weights by feature index, the entries of a sparse
    vector of as many features as ``index`` has rows."""
    weights = index.select("term", "index", idf("df", n_docs))
    return counts.join(weights, "term").select(
        key, F.col("index").cast("int").alias("index"), (F.col("tf") * F.col("idf")).alias("value")
    )

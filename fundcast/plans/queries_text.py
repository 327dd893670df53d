"""Registered queries over document text: word count, tokens, TF-IDF tables,
string index and assembled features."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from fundcast.catalog import register
from fundcast.functions.stopwords import sql_list_literal
from fundcast.operators import features as FT
from fundcast.operators import terms as TM
from fundcast.operators import text as T
from fundcast.operators.vectors import dense_entries, entries, entry, read_parts, sparse_vectors
from fundcast.plans import sql
from fundcast.plans.featurise import materialise_features
from fundcast.plans.queries_campaign import prepared
from fundcast.session import cut_lineage, scratch_path
from fundcast.sources import table

# Vocabulary threshold of the text tables (the original grid's lowest minDF); the vectors
# of ``sparse_tfidf`` have every term, as in the original's stage-by-stage featurisation.
TEXT_MIN_DF = 55
# Threshold for the campaign models: a fraction, so it scales with the data.
MODEL_MIN_DF = 0.01
DIGITS = 9

_WORDS_SQL = """parts AS (SELECT text, string_split_regex(text, '\\r\\n|\\n|\\r') AS p FROM documents),
lines AS (
  SELECT unnest(CASE WHEN text = '' THEN []::VARCHAR[]
                     WHEN regexp_matches(text, '(\\r\\n|\\n|\\r)\\z') THEN list_slice(p, 1, len(p) - 1)
                     ELSE p END) AS line
  FROM parts),
words AS (
  SELECT unnest(CASE WHEN line = '' THEN ['']
                     WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[]
                     ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM lines)"""

_TOKENS = "list_filter(string_split_regex(lower(text), '\\W+'), lambda z: length(z) >= 1)"
_FILTERED = f"list_filter({_TOKENS}, lambda w: NOT list_contains({sql_list_literal()}, w))"

_TERMS_SQL = f"""toks AS (SELECT doc_id, unnest({_FILTERED}) AS term FROM documents),
dfs AS (SELECT term, count(DISTINCT doc_id) AS df FROM toks GROUP BY term),
vocab AS (SELECT term, df FROM dfs WHERE df >= {TEXT_MIN_DF}),
ndocs AS (SELECT count(*) AS n FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks WHERE term IN (SELECT term FROM vocab) GROUP BY doc_id, term)"""

_ALL_TERMS_SQL = f"""toks AS (SELECT doc_id, unnest({_FILTERED}) AS term FROM documents),
vocab AS (SELECT term, count(DISTINCT doc_id) AS df FROM toks GROUP BY term),
ndocs AS (SELECT count(*) AS n FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term)"""


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def document_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", "text")


def filtered_tokens(spark, sf_dir):
    docs = document_text(spark, sf_dir)
    return FT.stop_words().transform(FT.tokenizer().transform(docs))


def text_vocabulary(spark, sf_dir):
    return TM.document_frequencies(filtered_tokens(spark, sf_dir), min_df=TEXT_MIN_DF)


def text_counts(spark, sf_dir):
    """(doc_id, term, tf) of the filtered tokens, and its vocabulary (term, df). The
    texts are tokenised once, into one row of counts per document; the vocabulary is
    written, so its size is known when it is joined."""
    documents = cut_lineage(TM.counted(filtered_tokens(spark, sf_dir)), "document-terms")
    counts = TM.spread(documents)
    return counts, cut_lineage(TM.vocabulary(counts, TEXT_MIN_DF), "vocabulary")


def all_text_counts(spark, sf_dir):
    """(doc_id, term, tf) of the filtered tokens, and the vocabulary (term, df) of all
    their terms. It is joined by a shuffle, so the counts are written as rows in the
    order of their terms: neighbours that begin alike take less to write and to shuffle."""
    counts = TM.term_counts(filtered_tokens(spark, sf_dir)).sortWithinPartitions("term")
    counts = cut_lineage(counts, "term-counts", "zstd")
    return counts, cut_lineage(TM.vocabulary(counts), "vocabulary", "zstd")


@register("word_count", f"WITH {_WORDS_SQL} SELECT word, count(*) AS count FROM words GROUP BY word")
def q_word_count(spark, sf_dir):
    return T.word_count(T.lines(document_text(spark, sf_dir), "text"))


@register(
    "word_count_top",
    f"WITH {_WORDS_SQL} SELECT word, count(*) AS count FROM words GROUP BY word "
    "ORDER BY count DESC, word ASC LIMIT 20",
)
def q_word_count_top(spark, sf_dir):
    return T.top_words(q_word_count(spark, sf_dir), 20)


@register(
    "tokens",
    f"SELECT doc_id, CAST(unnest(range(len(t))) AS INTEGER) AS pos, unnest(t) AS token "
    f"FROM (SELECT doc_id, {_TOKENS} AS t FROM documents)",
)
def q_tokens(spark, sf_dir):
    docs = document_text(spark, sf_dir)
    return T.long_tokens(FT.tokenizer().transform(docs), "doc_id", "tokens")


@register(
    "tokens_no_stopwords",
    f"SELECT doc_id, CAST(unnest(range(len(t))) AS INTEGER) AS pos, unnest(t) AS token "
    f"FROM (SELECT doc_id, {_FILTERED} AS t FROM documents)",
)
def q_tokens_no_stopwords(spark, sf_dir):
    return T.long_tokens(filtered_tokens(spark, sf_dir), "doc_id", "filtered")


@register(
    "count_vectors",
    f"WITH {_TERMS_SQL} SELECT doc_id, term, CAST(tf AS DOUBLE) AS tf FROM tf",
)
def q_count_vectors(spark, sf_dir):
    counts, vocab = text_counts(spark, sf_dir)
    return TM.kept_counts(counts, vocab).select("doc_id", "term", F.col("tf").cast("double").alias("tf"))


@register("vocabulary", f"WITH {_TERMS_SQL} SELECT term, df FROM vocab")
def q_vocabulary(spark, sf_dir):
    return text_vocabulary(spark, sf_dir)


@register(
    "feature_index",
    f"WITH {_TERMS_SQL} SELECT CAST(row_number() OVER (ORDER BY df DESC, term) - 1 AS BIGINT) AS index, term, df FROM vocab",
)
def q_feature_index(spark, sf_dir):
    """The feature index of the text: terms ranked over the cluster."""
    return TM.feature_index(text_vocabulary(spark, sf_dir))


@register(
    "sparse_tfidf",
    f"WITH {_ALL_TERMS_SQL}, ranked AS (SELECT row_number() OVER (ORDER BY df DESC, term) - 1 AS i, term, df FROM vocab), "
    "size AS (SELECT count(*) AS size FROM vocab) "
    f"SELECT doc_id, CAST(size AS INTEGER) AS size, CAST(i AS INTEGER) AS index, "
    f"round(tf * ln((n + 1.0) / (df + 1.0)), {DIGITS}) AS value FROM tf JOIN ranked USING (term), ndocs, size",
)
def q_sparse_tfidf(spark, sf_dir):
    """TF-IDF vectors of all documents over every term they hold, assembled
    without a vocabulary on the driver: their sizes and stored entries."""
    counts, vocab = all_text_counts(spark, sf_dir)
    rows = TM.indexed_weights(counts, TM.feature_index(vocab), documents(spark, sf_dir).count())
    path = scratch_path(spark, "tfidf-vectors")
    vectors = sparse_vectors(rows, "doc_id", vocab.count(), "tfidf", path)
    size = F.col("tfidf.size")
    parts = read_parts(spark, path, vectors.schema)
    return parts.select("doc_id", size.alias("size"), F.inline(entries(F.col("tfidf")))).select(
        "doc_id", "size", "index", F.round("value", DIGITS).alias("value")
    )


@register(
    "idf_weights",
    f"WITH {_TERMS_SQL} SELECT term, round(ln((n + 1.0) / (df + 1.0)), {DIGITS}) AS idf FROM vocab, ndocs",
)
def q_idf_weights(spark, sf_dir):
    vocab = text_vocabulary(spark, sf_dir)
    weights = TM.idf_weights(vocab, documents(spark, sf_dir).count())
    return weights.select("term", F.round("idf", DIGITS).alias("idf"))


@register(
    "tfidf",
    f"WITH {_TERMS_SQL} SELECT tf.doc_id, tf.term, round(tf.tf * ln((n + 1.0) / (vocab.df + 1.0)), {DIGITS}) AS weight "
    "FROM tf JOIN vocab USING (term), ndocs",
)
def q_tfidf(spark, sf_dir):
    counts, vocab = text_counts(spark, sf_dir)
    weighted = TM.tfidf(counts, vocab, documents(spark, sf_dir).count())
    return weighted.select("doc_id", "term", F.round("weight", DIGITS).alias("weight"))


@register(
    "string_index",
    "WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), "
    "r AS (SELECT lang, CAST(row_number() OVER (ORDER BY n DESC, lang ASC) - 1 AS DOUBLE) AS lang_index FROM c) "
    "SELECT d.doc_id, d.lang, r.lang_index FROM documents d JOIN r USING (lang)",
)
def q_string_index(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "lang")
    model = FT.indexer("lang", "lang_index").fit(docs)
    return model.transform(docs)


def _index_sql(col, name):
    return (
        f"{name} AS (SELECT {col}, row_number() OVER (ORDER BY count(*) DESC, {col} ASC) - 1 AS idx "
        f"FROM prep WHERE {col} IS NOT NULL GROUP BY {col}), "
        f"n_{name} AS (SELECT count(*) AS n FROM {name})"
    )


ASSEMBLED = ["days_campaign", "hours_prepa", "goal", "country_indexed", "currency_indexed"]


@register(
    "assemble_features",
    sql.with_prep(
        f", {_index_sql('country2', 'ci')}, {_index_sql('currency2', 'cu')}, "
        "feat AS (SELECT p.project_id, [CAST(p.days_campaign AS DOUBLE), p.hours_prepa, CAST(p.goal AS DOUBLE), "
        "CAST(coalesce(ci.idx, (SELECT n FROM n_ci)) AS DOUBLE), "
        "CAST(coalesce(cu.idx, (SELECT n FROM n_cu)) AS DOUBLE)] AS v "
        "FROM prep p LEFT JOIN ci ON p.country2 = ci.country2 LEFT JOIN cu ON p.currency2 = cu.currency2) "
        "SELECT project_id, CAST(unnest(range(5)) AS INTEGER) AS pos, unnest(v) AS value FROM feat"
    ),
)
def q_assemble_features(spark, sf_dir):
    prep = prepared(spark, sf_dir)
    stages = [
        FT.indexers([("country2", "country_indexed"), ("currency2", "currency_indexed")], "keep"),
        FT.assembler(ASSEMBLED, "features"),
    ]
    out = Pipeline(stages=stages).fit(prep).transform(prep)
    return dense_entries(out, ["project_id"], "features")


_PREP_TOKENS = _FILTERED.replace("lower(text)", "lower(p.text)")


@register(
    "features_roundtrip",
    sql.with_prep(
        f", ptoks AS (SELECT p.project_id, unnest({_PREP_TOKENS}) AS term FROM prep p), "
        "pdfs AS (SELECT term, count(DISTINCT project_id) AS df FROM ptoks GROUP BY term), "
        "nprep AS (SELECT count(*) AS n FROM prep), "
        f"vsize AS (SELECT count(*) AS v FROM pdfs, nprep WHERE df >= {MODEL_MIN_DF} * n) "
        f"SELECT project_id, CAST(v + {len(FT.FEATURE_INPUTS) - 1} AS INTEGER) AS n_features FROM prep, vsize"
    ),
)
def q_features_roundtrip(spark, sf_dir):
    """Stage-by-stage feature materialisation written as Parquet (vectors
    included) and read back: one row per campaign with its vector size."""
    return _stored_features(spark, sf_dir).select("project_id", F.col("features.size").alias("n_features"))


def _stored_features(spark, sf_dir):
    """(project_id, features) of every campaign, written as vectors and read as their parts."""
    path = materialise_features(
        prepared(spark, sf_dir), scratch_path(spark, "features"), MODEL_MIN_DF, "keep", ("project_id", "features")
    )
    return read_parts(spark, path, spark.read.parquet(path).schema)


@register(
    "features_values",
    sql.with_prep(
        f", ptoks AS (SELECT p.project_id, unnest({_PREP_TOKENS}) AS term FROM prep p), "
        "tfs AS (SELECT project_id, term, count(*) AS tf FROM ptoks GROUP BY project_id, term), "
        "nprep AS (SELECT count(*) AS n FROM prep), "
        "dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term), "
        "weighted AS (SELECT project_id, count(*) AS n_terms, sum(tf) AS tf, "
        "sum(tf * ln((n + 1.0) / (df + 1.0))) AS weight, max(tf * ln((n + 1.0) / (df + 1.0))) AS largest "
        f"FROM tfs JOIN dfs USING (term), nprep WHERE df >= {MODEL_MIN_DF} * n GROUP BY project_id), "
        f"{_index_sql('country2', 'ci')}, {_index_sql('currency2', 'cu')} "
        "SELECT p.project_id, coalesce(w.n_terms, 0) AS n_terms, round(coalesce(w.weight, 0.0), 5) AS weight, "
        "round(coalesce(w.largest, 0.0), 9) AS largest, "
        "CAST(p.days_campaign AS DOUBLE) AS days_campaign, p.hours_prepa, CAST(p.goal AS DOUBLE) AS goal, "
        "CAST(coalesce(ci.idx, (SELECT n FROM n_ci)) AS DOUBLE) AS country_indexed, "
        "CAST(coalesce(cu.idx, (SELECT n FROM n_cu)) AS DOUBLE) AS currency_indexed "
        "FROM prep p LEFT JOIN weighted w ON p.project_id = w.project_id "
        "LEFT JOIN ci ON p.country2 = ci.country2 LEFT JOIN cu ON p.currency2 = cu.currency2"
    ),
)
def q_features_values(spark, sf_dir):
    """What the stored feature vectors hold: per campaign the number, sum and largest of
    its TF-IDF entries, and the five other features."""
    parts = F.col("features")
    text = F.filter(entries(parts), lambda e: (e["index"] < parts["size"] - len(ASSEMBLED)) & (e["value"] != 0))
    values = F.transform(text, lambda e: e["value"])
    others = [entry(parts, parts["size"] - len(ASSEMBLED) + i).alias(c) for i, c in enumerate(ASSEMBLED)]
    return _stored_features(spark, sf_dir).select(
        "project_id",
        F.size(values).cast("long").alias("n_terms"),
        F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 5).alias("weight"),
        F.round(F.coalesce(F.array_max(values), F.lit(0.0)), 9).alias("largest"),
        *others,
    )

"""The registered queries of the operators in this package, and their DuckDB SQL.

Each query is thin: it applies its operator to the whole table and derives the
columns of its result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundcast.llm import (
    decontaminate, hard_negatives, mixing, quality, repeated_passages, signature_join, source_divergence, suffix_tree,
    surrogates, token_files, toxicity, url_rules, warc,
)
from fundcast.session import cut_lineage, scratch_path, share_code
from fundcast.sources.tables import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(share_code(spark), sf_dir)
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source"
    )


@query("mixing_targets", f"""
WITH d AS (SELECT source, len({_WORDS}) AS size FROM documents),
s AS (SELECT source, sum(size) AS source_size, count(*) AS n_docs FROM d GROUP BY source),
w AS (SELECT *, 2.0::DOUBLE * source_size AS cap,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
      FROM s),
f AS (SELECT *, sum(cap) OVER o - cap AS cap_before, sum(weight) OVER o - weight AS weight_before,
        1.5::DOUBLE * sum(source_size) OVER () AS words, sum(weight) OVER () AS weights
      FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
v AS (SELECT min_by(level, cap / weight) AS level FROM (
        SELECT (words - cap_before) / (weights - weight_before) AS level, weight, cap FROM f)
      WHERE level * weight <= cap)
SELECT source, source_size::BIGINT AS source_size, n_docs, round(least(cap, coalesce(level * weight, cap)), 6) AS target,
       round(least(cap, coalesce(level * weight, cap)))::BIGINT AS taken
FROM f, v
""")
def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix per source: what it aims at, and the words that its documents then give."""
    return mixing.mix(table(spark, sf_dir, "documents")).groupBy("source").agg(
        F.first("source_size").alias("source_size"), F.count("*").alias("n_docs"),
        F.round(F.first("target"), 6).alias("target"), F.sum("taken").alias("taken"),
    )


_BASE = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@query("quality_base", f"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
g AS (SELECT doc, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM (SELECT doc, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
r AS (SELECT doc, count(DISTINCT i + k.k) AS n FROM (
        SELECT doc, i FROM (SELECT *, count(*) OVER (PARTITION BY doc, g) AS times FROM g) WHERE times > 1),
        (VALUES (0), (1), (2)) k(k) GROUP BY doc),
l AS (SELECT doc, count(*) - count(DISTINCT line) AS n FROM (SELECT doc, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN l USING (doc) LEFT JOIN r USING (doc))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
""")
def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the quality rules measure of every document, before hosts are judged."""
    measured = cut_lineage(quality.measures(table(spark, sf_dir, "documents")), "quality")
    return quality.judge(measured).select(*_BASE)


@query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = cut_lineage(quality.measures(table(spark, sf_dir, "documents")), "quality")
    return quality.judge(measured).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "source", "host_rate",
    )


#: Fixed values of the URL query: hand-written rules (verdict, host, path).
URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]


@query("op4_url_rules")
def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    # a page's address carries the number of the document it shows
    shown = pages.select("url", F.regexp_extract(url_rules.path_of(F.col("url")), r"/(\d{1,18})", 1).alias("_n"))
    labels = table(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    labelled = shown.where("_n != ''").select("url", F.col("_n").cast("long").alias("doc_id")).join(labels, "doc_id")
    return url_rules.judge(pages, labelled.select("url", "bad"), URL_RULES)


@query("op6_decontamination")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def token_digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Token files of ``docs``, written and read back, as the columns of the contract."""
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    token_files.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query("op10_token_files")
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(spark, table(spark, sf_dir, "documents"))


@query("op3_warc", """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest AS d, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON payload_digest = d AND payload_bytes >= 100
""")
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    # responses are measured from the payload that was read back, revisits tell it in their headers
    return warc.read(spark, path).select(
        "page_id",
        F.coalesce(F.octet_length("payload").cast("long"), "payload_bytes").alias("payload_bytes"),
        F.coalesce(F.sha2("payload", 256), "payload_digest").alias("payload_digest"),
        "record_type", "refers_to",
    )


def _trainable(doc_id):
    return toxicity.fold(doc_id, 5) != 0


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, _trainable)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(toxicity.fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted", "hits"
    )


#: The query's key is public; a real run passes its own secret.
PII_KEY = b"op9 public test key"


@query("op9_surrogates")
def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY).select(
        "doc_id", "text", F.size("replaced").alias("n_replaced"), "replaced"
    )


@query("op7_signature_join")
def op7_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_join.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "class"
    )


@query("op1_suffix_tree")
def op1_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = suffix_tree.fit_and_score(table(spark, sf_dir, "documents"), lambda d: toxicity.fold(d, 7) != 2)
    return scored.select(
        "doc_id", F.coalesce(toxicity.fold(F.col("doc_id"), 7) == 2, F.lit(False)).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )


@query("op13_source_divergence", r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
           FROM documents),
t AS (SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT s.lang, s.source, coalesce(l.v, 0) AS v, l.n AS lang_n, coalesce(sum(c.n), 0)::HUGEINT AS n
      FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN l USING (lang) LEFT JOIN c USING (lang, source)
      GROUP BY s.lang, s.source, l.v, l.n),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS count,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * g.v) AS p,
             1 + (1000000000::HUGEINT * (k.total + 2)) // (g.lang_n + 2 * g.v) AS q
      FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                 sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
          GROUP BY a.lang, a.source, b.source
          UNION ALL
          SELECT a.lang, a.source, 'pair', b.source, 0 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          WHERE a.v = 0),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
          FROM p WHERE count > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 10
""")
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


@query("op11_hard_negatives", """
WITH v AS (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * x::DOUBLE) FOR x IN embedding] AS x
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.id AS anchor, b.id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
      FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 100 = 0),
p AS (SELECT anchor, id, score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5)
SELECT p.anchor AS anchor_id, p.id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id)::INT AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10
""")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.prepared(table(spark, sf_dir, "embeddings").withColumn("label", moved))
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


@query("op12_repeated_passages", """
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc, doc_id, i, substring(h, 2 * i + 1, 100) AS w
      FROM (SELECT *, unnest(range(0, len(h) // 2 - 49)) AS i FROM d WHERE len(h) >= 100)),
f AS (SELECT w, min(doc_id) AS first FROM w GROUP BY w),
m AS (SELECT doc, i, lag(i) OVER (PARTITION BY doc ORDER BY i) AS last FROM w JOIN f USING (w) WHERE first < doc_id),
r AS (SELECT doc, i, sum(CASE WHEN i <= last + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY i) AS run FROM m),
s AS (SELECT doc, min(i) AS b, max(i) + 50 AS e FROM r GROUP BY doc, run),
g AS (SELECT doc, b, e, coalesce(lag(e) OVER (PARTITION BY doc ORDER BY b), 0) AS before FROM s),
k AS (SELECT doc, count(*) AS n_spans, sum(e - b) AS n_removed, max(e) AS tail,
             string_agg(substring(h, 2 * before + 1, 2 * (b - before)), '' ORDER BY b) AS kept
      FROM g JOIN d USING (doc) GROUP BY doc)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substring(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (doc)
""")
def op12_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["begin"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )

"""The corpus pipeline: documents in, token files out.

Five stages in order: toxic documents go; of near duplicates one stays; documents
that contain a benchmark item go; sources are mixed to their target weights; the
rest becomes token-id files. Every stage takes (spark, docs, sf_dir), where docs
has the columns of ``documents`` (others are ignored), works on all rows of its
predecessor and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundcast.llm import decontaminate, mixing, signature_join, toxicity
from fundcast.llm.queries import ORACLES, QUERIES, token_digest
from fundcast.session import cut_lineage, share_code
from fundcast.sources.tables import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. It is fitted on the labelled
    documents of this stage's input; rows without an id are scored like others."""
    docs = _columns(docs)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component the document with the smallest doc_id stays, null ids last;
    among several texts with that id the one with the smallest hash. Documents
    without words all stay, being linked with nothing. Rows that repeat both id and
    text are one document."""
    docs = _columns(docs)
    placed = cut_lineage(signature_join.near_duplicates(docs), "near-duplicates")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    stay = placed.where("n_shingles > 0").groupBy("component").agg(first.alias("_first")).select(
        "component", F.col("_first.doc_id").alias("_id"), F.col("_first.text_hash").alias("_hash")
    )
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    chosen = docs.where(~wordless).join(
        stay, F.col("doc_id").eqNullSafe(F.col("_id")) & (signature_join.text_hash(F.col("text")) == F.col("_hash"))
    )
    one = chosen.groupBy("component").agg(F.min(F.struct("doc_id", "lang", "source", "n_chars", "text")).alias("_one"))
    return one.select(*[F.col(f"_one.{c}").alias(c) for c in COLUMNS]).unionByName(docs.where(wordless))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item within its error budget go."""
    return decontaminate.remove(_columns(docs), table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source is brought to its target: documents appear as often as the mix
    takes them, whole (the document at a source's cut by the nearer choice)."""
    return mixing.repeated(_columns(docs))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files of the mix, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_digest(spark, _columns(docs))


def _ready(stage):
    return lambda spark, docs, sf_dir: stage(share_code(spark), docs, sf_dir)


STAGES = [
    ("toxicity", _ready(drop_toxic)),
    ("n-gram Jaccard join", _ready(drop_near_duplicates)),
    ("benchmark decontamination", _ready(decontaminated)),
    ("mixing to target weights", _ready(mixed)),
    ("token files", _ready(token_files)),
]

#: The first and fourth stages (a fitted model, a hash order) have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs


LLM_QUERIES = {**QUERIES, "pipeline": run}
LLM_ORACLES = {**ORACLES, **({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})}

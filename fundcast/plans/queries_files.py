"""Registered queries for sources and sinks (CSV, text, Parquet round trips).

Intermediate files go below the session's shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fundcast.catalog import register
from fundcast.fixtures import campaign_table
from fundcast.operators import text as T
from fundcast.plans import sql
from fundcast.plans.prepare import prepare, prepare_file
from fundcast.plans.queries_campaign import prepared
from fundcast.plans.queries_text import _WORDS_SQL
from fundcast.plans.quote_repair import repair_csv_file
from fundcast.plans.wordcount import ordered_word_count_file
from fundcast.session import scratch_path
from fundcast.sinks import publish_parquet, read_published, write_csv, write_lines_with_header, write_parquet, write_text
from fundcast.sources import read_campaign_csv, read_parquet, read_strict_csv, table
from fundcast.sources.csv import MALFORMED, read_csv_with_malformed


@register(
    "csv_infer_null_token",
    sql.with_raw(
        "SELECT CAST(project_id AS INTEGER) AS project_id, nullif(name, 'false') AS name, "
        "nullif(\"desc\", 'false') AS \"desc\", nullif(goal, 'false') AS goal, "
        "nullif(keywords, 'false') AS keywords, "
        "CAST(nullif(disable_communication, 'false') AS BOOLEAN) AS disable_communication, "
        "nullif(country, 'false') AS country, nullif(currency, 'false') AS currency, "
        "CAST(deadline AS INTEGER) AS deadline, CAST(state_changed_at AS INTEGER) AS state_changed_at, "
        "CAST(created_at AS INTEGER) AS created_at, CAST(launched_at AS INTEGER) AS launched_at, "
        "CAST(backers_count AS INTEGER) AS backers_count, CAST(final_status AS INTEGER) AS final_status "
        "FROM raw"
    ),
)
def q_csv_infer_null_token(spark, sf_dir):
    path = write_csv(campaign_table(spark, sf_dir), scratch_path(spark, "campaign-csv"))
    return read_campaign_csv(spark, path, lossless=True)


# Malformed CSV as a naive export makes it: every line of every document becomes
# the row ``doc_id,lang,<line>`` with the line written unquoted (double quotes
# stripped) and left out when empty. A line holding commas gives the row extra
# cells, an empty one leaves it a cell short; DROPMALFORMED must drop exactly
# those rows and keep the rest as they were written.
MALFORMED_SCHEMA = "doc_id STRING, lang STRING, line STRING"


@register(
    "csv_drop_malformed",
    "WITH lines AS (SELECT doc_id, lang, "
    "replace(unnest(regexp_split_to_array(text, '\r\n|\n|\r')), '\"', '') AS line FROM documents) "
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, nullif(line, 'false') AS line FROM lines "
    "WHERE line <> '' AND strpos(line, ',') = 0",
)
def q_csv_drop_malformed(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.explode(F.split("text", "\r\n|\n|\r")).alias("line")
    )
    line = F.replace("line", F.lit('"'), F.lit(""))
    row = F.concat_ws(",", F.col("doc_id").cast("string"), F.col("lang"), F.nullif(line, F.lit("")))
    path = write_text(lines.select(row.alias("value")), "value", scratch_path(spark, "malformed-csv"))
    return read_strict_csv(spark, path, header=False, schema=MALFORMED_SCHEMA)


def _doubled_quote_lines(benchmark):
    """Whole benchmark texts, with what a CSV cell cannot carry unquoted written
    otherwise (comma as U+FE50, line break as U+2028, double quote as U+201D) and
    every space written as a doubled quote: ``id,a""b""c``."""
    cell = F.translate("text", ',\n\r"', "\ufe50\u2028\u2028\u201d")
    return benchmark.select(
        F.concat(F.col("item_id").cast("string"), F.lit(","), F.regexp_replace(cell, " ", '""')).alias("value")
    )


@register(
    "csv_quote_repair",
    "SELECT CAST(item_id AS VARCHAR) AS _c0, "
    "nullif(regexp_replace(translate(text, chr(44) || chr(10) || chr(13) || chr(34), "
    "chr(65104) || chr(8232) || chr(8232) || chr(8221)), ' +', ' ', 'g'), '') AS _c1 FROM benchmark",
)
def q_csv_quote_repair(spark, sf_dir):
    src = write_text(_doubled_quote_lines(table(spark, sf_dir, "benchmark")), "value", scratch_path(spark, "quoted"))
    return repair_csv_file(spark, src, scratch_path(spark, "repaired"))


@register("parquet_roundtrip", sql.with_prep("SELECT * FROM prep"))
def q_parquet_roundtrip(spark, sf_dir):
    path = write_parquet(prepared(spark, sf_dir), scratch_path(spark, "prepared"))
    return read_parquet(spark, path)


@register(
    "prepare_csv_to_parquet",
    sql.with_prep(
        "SELECT CAST(project_id AS INTEGER) AS project_id, name, \"desc\", goal, keywords, final_status, "
        "country2, currency2, deadline2, created_at2, launched_at2, days_campaign, hours_prepa, text FROM prep"
    ),
)
def q_prepare_csv_to_parquet(spark, sf_dir):
    """The preparation job end to end: campaign CSV → prepared Parquet."""
    csv_path = write_csv(campaign_table(spark, sf_dir), scratch_path(spark, "campaign-csv"))
    return read_parquet(spark, prepare_file(spark, csv_path, scratch_path(spark, "prepared-from-csv"), lossless=True))


@register(
    "csv_malformed_aside",
    "WITH lines AS (SELECT doc_id, lang, "
    "replace(unnest(regexp_split_to_array(text, '\r\n|\n|\r')), '\"', '') AS line FROM documents) "
    "SELECT CASE WHEN fits THEN CAST(doc_id AS VARCHAR) END AS doc_id, CASE WHEN fits THEN lang END AS lang, "
    "CASE WHEN fits THEN nullif(line, 'false') END AS line, "
    "CASE WHEN NOT fits THEN concat_ws(',', CAST(doc_id AS VARCHAR), lang, nullif(line, '')) END AS malformed "
    "FROM (SELECT *, line <> '' AND strpos(line, ',') = 0 AS fits FROM lines)",
)
def q_csv_malformed_aside(spark, sf_dir):
    """The malformed export with a header, read in one scan: rows that fit, and the text
    of those that do not."""
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.explode(F.split("text", "\r\n|\n|\r")).alias("line")
    )
    line = F.replace("line", F.lit('"'), F.lit(""))
    row = F.concat_ws(",", F.col("doc_id").cast("string"), F.col("lang"), F.nullif(line, F.lit("")))
    path = write_lines_with_header(
        lines.select(row.alias("value")), "doc_id,lang,line", scratch_path(spark, "malformed-header-csv")
    )
    rows = read_csv_with_malformed(spark, path)
    fits = F.col(MALFORMED).isNull()
    return rows.select(*[F.when(fits, F.col(c)).alias(c) for c in ("doc_id", "lang", "line")], MALFORMED)


#: What a cell of the default CSV form cannot hold, and what stands for it.
_UNSAFE, _SAFE = '\n\r"\\', "\u2028\u2028\u201d\u29f5"


@register(
    "csv_infer_default",
    sql.with_raw(
        "SELECT CAST(project_id AS INTEGER) AS project_id, "
        + "".join(
            f"nullif(translate({c}, chr(10) || chr(13) || chr(34) || chr(92), "
            f"chr(8232) || chr(8232) || chr(8221) || chr(10741)), 'false') AS {c}, "
            for c in ("name", '"desc"')
        )
        + "nullif(goal, 'false') AS goal, nullif(keywords, 'false') AS keywords, "
        "CAST(nullif(disable_communication, 'false') AS BOOLEAN) AS disable_communication, "
        "nullif(country, 'false') AS country, nullif(currency, 'false') AS currency, "
        "CAST(deadline AS INTEGER) AS deadline, CAST(state_changed_at AS INTEGER) AS state_changed_at, "
        "CAST(created_at AS INTEGER) AS created_at, CAST(launched_at AS INTEGER) AS launched_at, "
        "CAST(backers_count AS INTEGER) AS backers_count, CAST(final_status AS INTEGER) AS final_status FROM raw"
    ),
)
def q_csv_infer_default(spark, sf_dir):
    """The campaign CSV in its default form: header, inferred types, null token, files
    that split anywhere."""
    raw = campaign_table(spark, sf_dir)
    plain = raw.withColumns({c: F.translate(c, _UNSAFE, _SAFE) for c in ("name", "desc")})
    return read_campaign_csv(spark, write_csv(plain, scratch_path(spark, "campaign-default-csv")))


@register("published_replace", sql.with_prep("SELECT * FROM prep"))
def q_published_replace(spark, sf_dir):
    """A prepared table published twice: raw rows first, then the preparation of what
    was read back, which replaces them."""
    path = scratch_path(spark, "published")
    publish_parquet(campaign_table(spark, sf_dir), path)
    publish_parquet(prepare(read_published(spark, path)), path)
    return read_published(spark, path)


@register(
    "word_count_files",
    f"WITH {_WORDS_SQL}, counts AS (SELECT word, count(*) AS count FROM words GROUP BY word) "
    "SELECT word, count, row_number() OVER (ORDER BY count DESC, word) - 1 AS rank FROM counts",
)
def q_word_count_files(spark, sf_dir):
    """The word count job from text files: all words in the order of their counts."""
    lines = T.lines(table(spark, sf_dir, "documents").select("text"), "text")
    return ordered_word_count_file(spark, write_text(lines, "value", scratch_path(spark, "text-lines")))

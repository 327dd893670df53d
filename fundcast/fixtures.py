"""Campaign table derived from the driver's ``documents`` ⟕ ``labels``.

The original campaign CSV is not available, so test and bench queries build
an equivalent table from the given document data. The rules below are fixed
values that inject the edge cases the cleaning steps exist for: bad goals,
the ``false`` null token, shifted country/currency, negative preparation
times, deadlines before launch and labels beyond 0/1.

Scale note: every derived column is computed from ``documents`` *before* the
join; texts are kept whole (``name`` is their first 60 characters, ``desc``
the rest). ``labels`` is not broadcast by hint — AQE converts the join when its
measured size allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundcast.sources.tables import table

# Fixed values of the derivation rule.
BASE_EPOCH = 1400000000
LAUNCH_OFFSET = 5184000  # 60 days
HOUR = 3600
DEADLINE_MULT = 104729
DEADLINE_MOD = 5184000
DEADLINE_SHIFT = 259200  # 3 days
CREATED_MULT = 7919
CREATED_MOD = 2000003
CREATED_SHIFT = 100000
BACKERS_MULT = 31
BACKERS_MOD = 300


def campaign_columns(documents: DataFrame) -> DataFrame:
    d = F.col("doc_id")
    t0 = F.lit(BASE_EPOCH) + d * HOUR + LAUNCH_OFFSET
    deadline = t0 + (d * DEADLINE_MULT) % DEADLINE_MOD - DEADLINE_SHIFT
    code = F.when(F.col("lang") == "en", F.lit("US")).otherwise(F.upper("lang"))
    shifted = d % 20 == 0
    return documents.select(
        d.alias("project_id"),
        F.substring("text", 1, 60).alias("name"),
        F.expr("substring(text, 61)").alias("desc"),
        F.when(d % 89 == 0, F.lit("abc"))
        .when(d % 97 == 0, F.lit("0"))
        .when(d % 83 == 0, F.lit("100.5"))
        .when(d % 79 == 0, F.lit("1e3"))
        .when(d % 73 == 0, F.lit("12d"))
        .otherwise(F.col("n_chars").cast("string"))
        .alias("goal"),
        F.concat(F.col("source"), F.lit("-"), F.col("lang")).alias("keywords"),
        F.when(d % 50 == 0, F.lit("true")).otherwise(F.lit("false")).alias("disable_communication"),
        F.when(shifted, F.lit("false")).otherwise(code).alias("country"),
        F.when(shifted, code)
        .when(F.col("lang") == "en", F.lit("USD"))
        .otherwise(F.lit("EUR"))
        .alias("currency"),
        deadline.alias("deadline"),
        (deadline + 5).alias("state_changed_at"),
        (t0 - (d * CREATED_MULT) % CREATED_MOD + CREATED_SHIFT).alias("created_at"),
        t0.alias("launched_at"),
        ((d * BACKERS_MULT) % BACKERS_MOD).alias("backers_count"),
        (d % 5).alias("_status_default"),
    )


def campaign_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = campaign_columns(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("project_id"), "quality"
    )
    return docs.join(labels, "project_id", "left").select(
        "project_id",
        "name",
        "desc",
        "goal",
        "keywords",
        "disable_communication",
        "country",
        "currency",
        "deadline",
        "state_changed_at",
        "created_at",
        "launched_at",
        "backers_count",
        F.coalesce(F.col("quality").cast("long"), F.col("_status_default")).alias("final_status"),
    )


# SQL text of the same table, for the DuckDB oracles (``desc`` double-quoted).
CAMPAIGN_SQL = f"""
SELECT d.doc_id AS project_id,
       substr(d.text, 1, 60) AS name,
       substr(d.text, 61) AS "desc",
       CASE WHEN d.doc_id % 89 = 0 THEN 'abc'
            WHEN d.doc_id % 97 = 0 THEN '0'
            WHEN d.doc_id % 83 = 0 THEN '100.5'
            WHEN d.doc_id % 79 = 0 THEN '1e3'
            WHEN d.doc_id % 73 = 0 THEN '12d'
            ELSE CAST(d.n_chars AS VARCHAR) END AS goal,
       concat(d.source, '-', d.lang) AS keywords,
       CASE WHEN d.doc_id % 50 = 0 THEN 'true' ELSE 'false' END AS disable_communication,
       CASE WHEN d.doc_id % 20 = 0 THEN 'false'
            WHEN d.lang = 'en' THEN 'US' ELSE upper(d.lang) END AS country,
       CASE WHEN d.doc_id % 20 = 0 THEN (CASE WHEN d.lang = 'en' THEN 'US' ELSE upper(d.lang) END)
            WHEN d.lang = 'en' THEN 'USD' ELSE 'EUR' END AS currency,
       ({BASE_EPOCH} + d.doc_id * {HOUR} + {LAUNCH_OFFSET}) + (d.doc_id * {DEADLINE_MULT}) % {DEADLINE_MOD} - {DEADLINE_SHIFT} AS deadline,
       ({BASE_EPOCH} + d.doc_id * {HOUR} + {LAUNCH_OFFSET}) + (d.doc_id * {DEADLINE_MULT}) % {DEADLINE_MOD} - {DEADLINE_SHIFT} + 5 AS state_changed_at,
       ({BASE_EPOCH} + d.doc_id * {HOUR} + {LAUNCH_OFFSET}) - (d.doc_id * {CREATED_MULT}) % {CREATED_MOD} + {CREATED_SHIFT} AS created_at,
       ({BASE_EPOCH} + d.doc_id * {HOUR} + {LAUNCH_OFFSET}) AS launched_at,
       (d.doc_id * {BACKERS_MULT}) % {BACKERS_MOD} AS backers_count,
       coalesce(CAST(l.quality AS BIGINT), d.doc_id % 5) AS final_status
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

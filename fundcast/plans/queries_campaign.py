"""Registered queries over the campaign table (preparation and exploration)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundcast.catalog import register
from fundcast.fixtures import campaign_table
from fundcast.operators import profile
from fundcast.plans import explore as X
from fundcast.plans import prepare as P
from fundcast.plans import sql
from fundcast.plans.prepare import prepare
from fundcast.session import cut_lineage


def prepared(spark, sf_dir):
    return prepare(campaign_table(spark, sf_dir))


@register("prepare_campaigns", sql.with_prep("SELECT * FROM prep"))
def q_prepare_campaigns(spark, sf_dir):
    return prepared(spark, sf_dir)


@register(
    "class_balance",
    sql.with_prep("SELECT final_status, count(*) AS count FROM prep GROUP BY final_status"),
)
def q_class_balance(spark, sf_dir):
    return prepared(spark, sf_dir).groupBy("final_status").count().orderBy(F.desc("count"))


def raw_table(spark, sf_dir):
    return campaign_table(spark, sf_dir)


def cast_raw(spark, sf_dir):
    """The campaign table as the CSV reader would give it, then cast."""
    return P.cast_columns(P.apply_null_token(campaign_table(spark, sf_dir)))


RAW_COLUMNS = (
    "project_id", "name", "desc", "goal", "keywords", "disable_communication", "country",
    "currency", "deadline", "state_changed_at", "created_at", "launched_at", "backers_count",
    "final_status",
)


@register("profile_shape", sql.with_raw(f"SELECT count(*) AS n_rows, {len(RAW_COLUMNS)} AS n_columns FROM raw"))
def q_profile_shape(spark, sf_dir):
    return profile.shape(raw_table(spark, sf_dir))


PREP_SCHEMA = (
    ("project_id", "bigint"), ("name", "string"), ("desc", "string"), ("goal", "int"),
    ("keywords", "string"), ("final_status", "int"), ("country2", "string"),
    ("currency2", "string"), ("deadline2", "string"), ("created_at2", "string"),
    ("launched_at2", "string"), ("days_campaign", "int"), ("hours_prepa", "double"),
    ("text", "string"),
)


def _schema_sql():
    parts = []
    for i, (c, t) in enumerate(PREP_SCHEMA):
        parts.append(
            f"SELECT {i + 1} AS position, '{c}' AS col_name, '{t}' AS data_type, "
            f"count(\"{c}\") AS non_null FROM prep"
        )
    return sql.with_prep(" UNION ALL ".join(parts))


@register("profile_schema", _schema_sql())
def q_profile_schema(spark, sf_dir):
    return profile.schema_report(prepared(spark, sf_dir))


@register("preview_first_n", sql.with_raw("SELECT * FROM raw ORDER BY project_id LIMIT 20"))
def q_preview_first_n(spark, sf_dir):
    return profile.preview(raw_table(spark, sf_dir), 20, ["project_id"])


def _describe_sql(cols):
    parts = [
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
        f"CAST(max({c}) AS DOUBLE) AS max FROM cast_raw"
        for c in cols
    ]
    return sql.with_cast(" UNION ALL ".join(parts))


DESCRIBE_COLUMNS = ["goal", "backers_count", "final_status"]


@register("describe_numeric", _describe_sql(DESCRIBE_COLUMNS))
def q_describe_numeric(spark, sf_dir):
    return profile.describe_numeric(cast_raw(spark, sf_dir), DESCRIBE_COLUMNS)


@register(
    "cast_int_lenient",
    sql.with_cast(
        "SELECT project_id, goal, deadline, state_changed_at, created_at, launched_at, "
        "backers_count, final_status FROM cast_raw"
    ),
)
def q_cast_int_lenient(spark, sf_dir):
    return cast_raw(spark, sf_dir).select("project_id", *P.INT_COLUMNS)


@register(
    "drop_columns",
    sql.with_cast(
        'SELECT project_id, name, "desc", goal, keywords, country, currency, deadline, '
        "created_at, launched_at, final_status FROM cast_raw"
    ),
)
def q_drop_columns(spark, sf_dir):
    return P.drop_leakage(cast_raw(spark, sf_dir))


@register(
    "missing_country_currencies",
    sql.with_cast("SELECT currency, count(*) AS count FROM cast_raw WHERE country IS NULL GROUP BY currency"),
)
def q_missing_country_currencies(spark, sf_dir):
    return profile.filtered_frequency(cast_raw(spark, sf_dir), F.col("country").isNull(), "currency")


@register("freq_one_key", sql.with_cast("SELECT country, count(*) AS count FROM cast_raw GROUP BY country"))
def q_freq_one_key(spark, sf_dir):
    return profile.frequency(cast_raw(spark, sf_dir), "country")


@register(
    "freq_two_keys",
    sql.with_cast(
        "SELECT country, currency, count(*) AS count FROM cast_raw GROUP BY country, currency "
        "ORDER BY count DESC, country ASC NULLS FIRST, currency ASC NULLS FIRST LIMIT 50"
    ),
)
def q_freq_two_keys(spark, sf_dir):
    return profile.top_k(cast_raw(spark, sf_dir), ["country", "currency"], 50)


@register("distinct_deadlines", sql.with_cast("SELECT DISTINCT deadline FROM cast_raw"))
def q_distinct_deadlines(spark, sf_dir):
    return profile.distinct_values(cast_raw(spark, sf_dir), "deadline")


_DUR_SQL = f"""durs AS (
  SELECT project_id, goal,
         {sql.ts_text_sql('deadline')} AS deadline2,
         {sql.ts_text_sql('created_at')} AS created_at2,
         {sql.ts_text_sql('launched_at')} AS launched_at2,
         CAST(date_diff('day', {sql.day_sql('launched_at')}, {sql.day_sql('deadline')}) AS INTEGER) AS days_campaign,
         {sql.hours_sql('launched_at', 'created_at')} AS hours_prepa
  FROM cast_raw)"""


@register(
    "fill_nulls",
    sql.with_cast(
        f", {_DUR_SQL} SELECT project_id, coalesce(goal, -1) AS goal, "
        "coalesce(days_campaign, -1) AS days_campaign, coalesce(hours_prepa, -1.0) AS hours_prepa FROM durs"
    ),
)
def q_fill_nulls(spark, sf_dir):
    df = P.fill_missing(P.durations(cast_raw(spark, sf_dir)))
    return df.select("project_id", "goal", "days_campaign", "hours_prepa")


@register(
    "durations",
    sql.with_cast(
        f", {_DUR_SQL} SELECT project_id, deadline2, created_at2, launched_at2, days_campaign, hours_prepa FROM durs"
    ),
)
def q_durations(spark, sf_dir):
    return P.durations(cast_raw(spark, sf_dir)).select(
        "project_id", "deadline2", "created_at2", "launched_at2", "days_campaign", "hours_prepa"
    )


@register(
    "repair_country_currency",
    sql.with_cast(
        "SELECT project_id, coalesce(country, currency) AS country2, "
        "CASE WHEN length(currency) = 3 THEN currency END AS currency2 FROM cast_raw"
    ),
)
def q_repair_country_currency(spark, sf_dir):
    return P.repair_country_currency(cast_raw(spark, sf_dir)).select("project_id", "country2", "currency2")


@register(
    "text_concat_lower",
    sql.with_cast(
        'SELECT project_id, lower(name) AS name, lower("desc") AS "desc", lower(keywords) AS keywords, '
        "concat_ws(' ', lower(name), lower(\"desc\"), lower(keywords)) AS text FROM cast_raw"
    ),
)
def q_text_concat_lower(spark, sf_dir):
    return P.add_text(P.lower_text(cast_raw(spark, sf_dir))).select(
        "project_id", "name", "desc", "keywords", "text"
    )


REPORT_KEYS = ["final_status", "disable_communication", "country", "currency", "state_changed_at", "backers_count"]


@register(
    "freq_report",
    sql.with_cast(
        " UNION ALL ".join(
            f"SELECT '{k}' AS \"column\", CAST({k} AS VARCHAR) AS value, count(*) AS count FROM cast_raw GROUP BY {k}"
            for k in REPORT_KEYS
        )
    ),
)
def q_freq_report(spark, sf_dir):
    """The exploration job's one-key frequency tables, all from one scan."""
    return profile.frequencies(cast_raw(spark, sf_dir), REPORT_KEYS)


def _report_sql():
    none = "NULL::VARCHAR"
    parts = []

    def group(report, key1, key2=none, source="cast_raw", where="TRUE"):
        parts.append(
            f"SELECT '{report}' AS report, CAST({key1} AS VARCHAR) AS key1, CAST({key2} AS VARCHAR) AS key2, count(*) AS n_rows, "
            f"0 AS n_values, NULL::DOUBLE AS mean, NULL::DOUBLE AS stddev, NULL::DOUBLE AS min, NULL::DOUBLE AS max "
            f"FROM {source} WHERE {where} GROUP BY ALL"
        )

    for c in RAW_COLUMNS:
        v = f"CASE WHEN \"{c}\" IS NOT NULL THEN 1.0::DOUBLE END"
        parts.append(_figures("columns", c, v, "cast_raw"))
    for c in ("goal", "backers_count", "final_status"):
        parts.append(_figures("describe", c, f"CAST({c} AS DOUBLE)", "cast_raw"))
    for c in ("final_status", "disable_communication", "country", "currency", "state_changed_at", "backers_count", "deadline"):
        group(c, c)
    two = "coalesce(country, currency)", "CASE WHEN length(currency) = 3 THEN currency END"
    group("country, currency", "country", "currency")
    group("currency of missing country", "currency", where="country IS NULL")
    group("country2, currency2", *two)
    group("country2", two[0])
    group("currency2", two[1])
    group("prepared", "final_status", source="prep")
    union = " UNION ALL ".join(parts)
    return (
        f", said AS ({union}) SELECT report, key1, key2, CAST(row_number() OVER (PARTITION BY report ORDER BY n_rows DESC, "
        "key1 NULLS FIRST, key2 NULLS FIRST) AS INTEGER) AS place, n_rows, n_values, mean, stddev, min, max FROM said "
        f"QUALIFY place <= CASE WHEN contains(report, ',') THEN {X.TOP_PAIRS} ELSE {X.TOP} END"
    )


def _figures(report, column, value, source):
    return (
        f"SELECT '{report}' AS report, '{column}' AS key1, NULL::VARCHAR AS key2, count(*) AS n_rows, count(v) AS n_values, "
        f"round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS stddev, min(v) AS min, max(v) AS max "
        f"FROM (SELECT {value} AS v FROM {source})"
    )


@register("explore_report", sql.with_prep(_report_sql()))
def q_explore_report(spark, sf_dir):
    """All exploration reports of a snapshot, from one scan of it."""
    return X.report(cut_lineage(campaign_table(spark, sf_dir), "snapshot"), "false")

"""DuckDB-dialect SQL equivalents of the jobs, used as independent oracles.

Written against the driver's tables (``documents``, ``labels``, …) only.
Spark and DuckDB differ in a few places, handled here explicitly:
DuckDB rounds where Spark truncates on double → int, DuckDB's ``round`` on
doubles differs from Spark's half-up on the shortest decimal (so hours are
rounded in integer arithmetic), and ``desc`` needs double quotes.
"""

from __future__ import annotations

from fundcast.fixtures import CAMPAIGN_SQL
from fundcast.functions.casts import INT_PATTERN


def lenient_int_sql(expr: str) -> str:
    text = f"CAST({expr} AS VARCHAR)"
    return (
        f"CASE WHEN regexp_matches({text}, '{INT_PATTERN}') "
        f"THEN TRY_CAST(trunc(TRY_CAST({text} AS DOUBLE)) AS INTEGER) END"
    )


def ts_text_sql(expr: str) -> str:
    return f"strftime(make_timestamp(CAST({expr} AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S')"


def day_sql(expr: str) -> str:
    return f"CAST(make_timestamp(CAST({expr} AS BIGINT) * 1000000) AS DATE)"


def hours_sql(later: str, earlier: str) -> str:
    s = f"(CAST({later} AS BIGINT) - CAST({earlier} AS BIGINT))"
    return (
        f"(CASE WHEN {s} >= 0 THEN CAST(({s} * 2000 + 3600) // 7200 AS DOUBLE) / 1000.0 "
        f"ELSE -CAST(((-{s}) * 2000 + 3600) // 7200 AS DOUBLE) / 1000.0 END)"
    )


RAW = f"raw AS ({CAMPAIGN_SQL})"

CAST_RAW = f"""cast_raw AS (
  SELECT project_id,
         nullif(name, 'false') AS name,
         nullif("desc", 'false') AS "desc",
         {lenient_int_sql("nullif(goal, 'false')")} AS goal,
         nullif(keywords, 'false') AS keywords,
         nullif(disable_communication, 'false') AS disable_communication,
         nullif(country, 'false') AS country,
         nullif(currency, 'false') AS currency,
         {lenient_int_sql('deadline')} AS deadline,
         {lenient_int_sql('state_changed_at')} AS state_changed_at,
         {lenient_int_sql('created_at')} AS created_at,
         {lenient_int_sql('launched_at')} AS launched_at,
         {lenient_int_sql('backers_count')} AS backers_count,
         {lenient_int_sql('final_status')} AS final_status
  FROM raw)"""

PREP = f"""prep_all AS (
  SELECT project_id,
         lower(name) AS name,
         lower("desc") AS "desc",
         goal,
         lower(keywords) AS keywords,
         final_status,
         coalesce(country, currency) AS country2,
         CASE WHEN length(currency) = 3 THEN currency END AS currency2,
         {ts_text_sql('deadline')} AS deadline2,
         {ts_text_sql('created_at')} AS created_at2,
         {ts_text_sql('launched_at')} AS launched_at2,
         CAST(date_diff('day', {day_sql('launched_at')}, {day_sql('deadline')}) AS INTEGER) AS days_campaign,
         {hours_sql('launched_at', 'created_at')} AS hours_prepa,
         concat_ws(' ', lower(name), lower("desc"), lower(keywords)) AS text
  FROM cast_raw),
prep AS (
  SELECT * FROM prep_all
  WHERE hours_prepa >= 0 AND days_campaign >= 0 AND goal > 0 AND final_status IN (0, 1))"""


def with_prep(select: str) -> str:
    return f"WITH {RAW}, {CAST_RAW}, {PREP} {select}"


def with_cast(select: str) -> str:
    return f"WITH {RAW}, {CAST_RAW} {select}"


def with_raw(select: str) -> str:
    return f"WITH {RAW} {select}"

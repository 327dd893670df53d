"""Driver contract and a DuckDB comparison for a sample of queries."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

from conftest import SF_SMALL

CHEAP = [
    "prepare_campaigns", "class_balance", "freq_two_keys", "describe_numeric", "durations",
    "word_count", "tokens_no_stopwords", "tfidf", "string_index", "assemble_features",
    "weighted_f1", "csv_infer_null_token", "csv_quote_repair",
]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["final_status", "count"]
    assert df.count() >= 1


def test_registry_consistent():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 40


def _norm(rows):
    def n(v):
        if isinstance(v, float):
            return 0.0 if v == 0 else float(f"{v:.9g}")
        return v

    return sorted((tuple(n(x) for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", CHEAP)
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sdf = entry.queries()[name](spark, SF_SMALL)
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(sdf.columns)
    drows = [tuple(r[cols.index(c)] for c in sdf.columns) for r in res.fetchall()]
    assert _norm(sdf.collect()) == _norm(drows)
    assert not math.isnan(0.0)


@pytest.mark.parametrize("name", ["durations", "fill_nulls"])
def test_time_queries_do_not_depend_on_session_zone(spark, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        con = duckdb.connect()
        for t in ("documents", "labels"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
        sdf = entry.queries()[name](spark, SF_SMALL)
        res = con.execute(entry.oracle_sql()[name])
        cols = [d[0] for d in res.description]
        drows = [tuple(r[cols.index(c)] for c in sdf.columns) for r in res.fetchall()]
        assert _norm(sdf.collect()) == _norm(drows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

"""Campaign preparation on the edge rows of the fixture description."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fundcast.plans import prepare as P

COLS = (
    "project_id long, name string, desc string, goal string, keywords string, "
    "disable_communication string, country string, currency string, deadline long, "
    "state_changed_at long, created_at long, launched_at long, backers_count long, final_status string"
)
T0 = 1400000000


def row(pid, goal="1000", country="US", currency="USD", created_delta=3600, days=30, status="1",
        name="Name", desc="Desc", keywords="kw"):
    launched = T0 + pid * 86400
    return (pid, name, desc, goal, keywords, "false", country, currency, launched + days * 86400,
            launched + days * 86400 + 5, launched - created_delta, launched, 3, status)


def prep_rows(spark, rows):
    out = P.prepare(spark.createDataFrame(rows, COLS))
    return {r["project_id"]: r for r in out.collect()}


def test_goal_edge_values(spark):
    got = prep_rows(spark, [row(1, "abc"), row(2, "100.5"), row(3, "0"), row(4, "99999999999"), row(5, "250")])
    assert set(got) == {2, 5}
    assert got[2]["goal"] == 100 and got[5]["goal"] == 250


def test_country_currency_repair(spark):
    got = prep_rows(
        spark,
        [row(1, country="false", currency="FR"), row(2, currency=None), row(3, country="US", currency="USDX")],
    )
    assert (got[1]["country2"], got[1]["currency2"]) == ("FR", None)
    assert (got[2]["country2"], got[2]["currency2"]) == ("US", None)
    assert got[3]["currency2"] is None


def test_texts_null_give_empty_text(spark):
    got = prep_rows(spark, [row(1, name=None, desc=None, keywords=None), row(2, name="AbC", desc="D", keywords="K")])
    assert got[1]["text"] == ""
    assert got[2]["text"] == "abc d k"


def test_preparation_time_boundaries(spark):
    got = prep_rows(spark, [row(1, created_delta=0), row(2, created_delta=-1), row(3, created_delta=-2)])
    assert set(got) == {1, 2}
    assert got[2]["hours_prepa"] == 0.0


def test_deadline_before_launch_removed(spark):
    got = prep_rows(spark, [row(1, days=-1), row(2, days=0)])
    assert set(got) == {2}
    assert got[2]["days_campaign"] == 0


def test_labels_beyond_binary_removed(spark):
    got = prep_rows(spark, [row(1, status="2"), row(2, status=None), row(3, status="0"), row(4, status="False")])
    assert set(got) == {3}


def test_output_schema_and_dates(spark):
    df = P.prepare(spark.createDataFrame([row(1)], COLS))
    assert df.columns == [
        "project_id", "name", "desc", "goal", "keywords", "final_status", "country2", "currency2",
        "deadline2", "created_at2", "launched_at2", "days_campaign", "hours_prepa", "text",
    ]
    r = df.first()
    assert r["launched_at2"] == "2014-05-14 16:53:20"
    assert r["hours_prepa"] == 1.0 and r["days_campaign"] == 30


def test_fill_fires_only_without_filters(spark):
    df = spark.createDataFrame([(1, None, None, None)], "id int, days_campaign int, hours_prepa double, goal int")
    r = P.fill_missing(df).first()
    assert (r["days_campaign"], r["hours_prepa"], r["goal"]) == (-1, -1.0, -1)


def test_plan_has_no_shuffle(spark):
    df = P.prepare(spark.createDataFrame([row(1)], COLS))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@settings(max_examples=25, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["abc", "0", "-5", "10", "100.5", None, "false"]),
            st.integers(-3, 3),
            st.integers(-2, 40),
            st.sampled_from(["0", "1", "2", None]),
        ),
        min_size=1,
        max_size=12,
    )
)
def test_output_always_satisfies_filters(spark, specs):
    rows = [row(i, goal=g, created_delta=c, days=d, status=s) for i, (g, c, d, s) in enumerate(specs)]
    out = P.prepare(spark.createDataFrame(rows, COLS))
    bad = out.filter(
        (F.col("goal") <= 0) | (F.col("hours_prepa") < 0) | (F.col("days_campaign") < 0)
        | ~F.col("final_status").isin(0, 1)
    )
    assert bad.count() == 0


@pytest.mark.parametrize("tz", ["America/New_York"])
def test_prepare_pins_utc(spark, tz):
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        r = P.prepare(spark.createDataFrame([row(1)], COLS)).first()
        assert r["launched_at2"] == "2014-05-14 16:53:20"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

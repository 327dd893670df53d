"""Property: the Spark preparation equals the DuckDB SQL form on random rows."""

import duckdb
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from fundcast.plans import sql
from fundcast.plans.prepare import prepare

from test_prepare import COLS

T0 = 1400000000
GOALS = ["abc", "0", "100.5", "99999999999", "-3", "12", "7.9", "false", None, "1e3"]
COUNTRIES = ["US", "FR", "false", None, "D"]
CURRENCIES = ["USD", "EUR", "GB", "false", None, "EURO"]
STATUSES = ["0", "1", "2", None, "false", "1.0"]

row = st.tuples(
    st.sampled_from(GOALS),
    st.sampled_from(COUNTRIES),
    st.sampled_from(CURRENCIES),
    st.integers(-7200, 400000),  # launched - created, seconds: rounding boundaries included
    st.integers(-200000, 5000000),  # deadline - launched, seconds
    st.integers(0, 86399),  # launch second of day
    st.sampled_from(STATUSES),
    st.sampled_from(["Nm", None, "A b"]),
)


def _frame(specs):
    rows = []
    for i, (goal, country, currency, prep_s, dur_s, sod, status, name) in enumerate(specs):
        launched = T0 + i * 86400 + sod
        rows.append((i, name, "Desc", goal, "kw", "false", country, currency, launched + dur_s,
                     launched + dur_s + 5, launched - prep_s, launched, 3, status))
    return rows


@settings(max_examples=30, deadline=None)
@given(st.lists(row, min_size=1, max_size=25))
def test_prepare_equals_sql(spark, specs):
    rows = _frame(specs)
    got = prepare(spark.createDataFrame(rows, COLS)).toPandas()
    names = [c.split(" ")[0] for c in COLS.split(", ")]
    raw = pd.DataFrame(rows, columns=names)
    con = duckdb.connect()
    con.register("raw_input", raw)
    query = f"WITH raw AS (SELECT * FROM raw_input), {sql.CAST_RAW}, {sql.PREP} SELECT * FROM prep"
    want = con.execute(query).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = list(got.columns)

    def norm(df):
        out = []
        for r in df[cols].itertuples(index=False):
            out.append(tuple(None if pd.isna(v) else (float(v) if isinstance(v, float) else v) for v in r))
        return sorted(out, key=repr)

    assert norm(got) == norm(want)

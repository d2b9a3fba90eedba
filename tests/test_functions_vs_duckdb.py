"""The pinned helpers agree with DuckDB on randomized inputs (hypothesis)."""

from __future__ import annotations

from datetime import datetime, timedelta

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from bazaar.functions import hour_boundaries_between, ratio_pct, round2

DUCK = duckdb.connect()


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.floats(min_value=-1e6, max_value=1e6, allow_nan=False),
            st.integers(min_value=-10**7, max_value=10**7).map(lambda i: i / 1000),  # 3-dp ties
        ),
        min_size=1,
        max_size=60,
    )
)
def test_round2_matches_duckdb(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, x double")
    got = {r["i"]: r["r"] for r in df.select("i", round2("x").alias("r")).collect()}
    want = dict(DUCK.execute("SELECT i, round(x, 2) FROM (SELECT unnest(range(?)) AS i, unnest(?::DOUBLE[]) AS x)", [len(values), values]).fetchall())
    for i, v in enumerate(values):
        assert repr(got[i]) == repr(want[i]), (v, got[i], want[i])


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.integers(min_value=0, max_value=10**8),  # seconds after 2020-01-01
            st.integers(min_value=0, max_value=10**6),  # seconds until the end
        ),
        min_size=1,
        max_size=60,
    )
)
def test_hour_boundaries_match_duckdb_date_diff(spark, spans):
    base = datetime(2020, 1, 1)
    rows = [(i, base + timedelta(seconds=a), base + timedelta(seconds=a + b)) for i, (a, b) in enumerate(spans)]
    df = spark.createDataFrame(rows, "i long, a timestamp_ntz, b timestamp_ntz")
    got = {r["i"]: r["h"] for r in df.select("i", hour_boundaries_between(df.a, df.b).alias("h")).collect()}
    for i, a, b in rows:
        want = DUCK.execute("SELECT date_diff('hour', ?::TIMESTAMP, ?::TIMESTAMP)", [a, b]).fetchone()[0]
        assert got[i] == want, (a, b, got[i], want)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5000), st.integers(0, 5000)), min_size=1, max_size=60))
def test_ratio_pct_matches_duckdb(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i long, a long, b long")
    got = {r["i"]: r["p"] for r in df.select("i", ratio_pct(df.a, df.b).alias("p")).collect()}
    for i, (a, b) in enumerate(pairs):
        want = DUCK.execute("SELECT round(100.0 * ?::BIGINT / nullif(?::BIGINT, 0), 2)", [a, b]).fetchone()[0]
        assert repr(got[i]) == repr(want), (a, b, got[i], want)

"""Every registered query against its DuckDB SQL on the smallest driver tables."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import rows_of  # noqa: E402
from contrail.plans.common_flight import OUTPUT_COLUMNS  # noqa: E402
from contrail.plans.oracle import SQL  # noqa: E402
from contrail.plans.queries import QUERIES  # noqa: E402
from contrail.sources.tables import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(SQL)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == OUTPUT_COLUMNS
    assert df.count() > 0


@pytest.mark.parametrize("name", ["q10", "q18", "q22", "q23", "q24"])
def test_results_do_not_depend_on_session_zone(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        test_query_matches_oracle(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_when_created_is_wall_clock(spark):
    import datetime as dt
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        row = entry.queries()["q28"](spark, SF).select("when_created").limit(1).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.when_created == dt.datetime(2024, 2, 1)

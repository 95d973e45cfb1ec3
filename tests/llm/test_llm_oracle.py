"""The operators that SQL expresses, against DuckDB on the smallest tables."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

from contrail.llm.queries import QUERIES, SQL
from contrail.sources.tables import TABLES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

from check_oracle import rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_operator_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = con.execute(SQL[name])
    cols, want = [c[0] for c in found.description], found.fetchall()
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, want)

"""Every query with SQL gives the same rows as DuckDB."""

from __future__ import annotations

import math

import duckdb
import pytest

from workload.oracles import ORACLES
from workload.queries import QUERIES
from workload.views import TABLES


@pytest.fixture(scope="module")
def con(small):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return c


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return float(v) + 0.0
    return v


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in values), key=repr)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, small, con, name):
    ours = QUERIES[name](spark, small)
    theirs = con.sql(ORACLES[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    got = rows(ours.columns, [tuple(r) for r in ours.collect()])
    want = rows(theirs.columns, theirs.fetchall())
    assert len(got) == len(want)
    assert got == want

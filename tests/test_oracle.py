"""Every registered query against its DuckDB SQL on the smallest scale factor: row count, column names and the
values (order-insensitive)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tidemark.catalog import REGISTRY
from tools.oracle_check import duck, rows_of

NAMES = sorted(REGISTRY)
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle_sql():
    assert set(NAMES) <= set(SQL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = rows_of(df.columns, df.collect())
    res = con.execute(SQL[name])
    cols = [d[0] for d in res.description]
    want = rows_of(cols, res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert got == want


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "alerts_within_30min" in df.columns

"""Every query of the subpackage that SQL can express, by value on the smallest scale factor."""

from __future__ import annotations

import pytest

from tests.conftest import SF_SMALL
from tidemark.llm.queries import QUERIES
from tidemark.llm.sql import SQL
from tools.oracle_check import duck, rows_of


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = rows_of(df.columns, df.collect())
    res = duck(SF_SMALL).execute(SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == rows_of(cols, res.fetchall())


def test_entry_registers_them():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, len(QUERIES) + 1))

"""Every registered query against its SQL on a second engine."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from gridpulse.sources.scratch import scope, scratch_root
from tests.conftest import SF
from tests.oracle import connect, differences

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_sql_belongs_to_a_query():
    assert not set(SQL) - set(QUERIES)


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 10
    assert [r.total_activity for r in rows] == sorted((r.total_activity for r in rows), reverse=True)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    root = Path(scratch_root(spark).removeprefix("file://"))
    before = set(root.iterdir())
    with scope(spark):
        df = QUERIES[name](spark, SF)
        if name in SQL:
            assert differences(df, con, SQL[name]) == []
        else:
            assert df.count() > 0
    assert set(root.iterdir()) <= before, "scratch tables are left"

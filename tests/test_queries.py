"""Every query over the smallest given tables, against its SQL where there is one."""

from __future__ import annotations

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import connect, rows_of

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def engine():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, engine, name):
    df = queries()[name](spark, SF_DIR)
    got = rows_of(df.columns, [tuple(row) for row in df.collect()])
    if name not in oracle_sql():
        assert got
        return
    result = engine.execute(oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, result.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())

"""Every registered query against its oracle at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import norm, rows_sorted
from tessella.fixtures import TABLES
from tests.conftest import SF

from tessella.queries import load  # noqa: E402

QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.items() <= entry.oracle_sql().items()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    columns, rows = rows_sorted(frame.columns, frame.collect())
    if name not in ORACLES:
        assert rows
        return
    result = duck.execute(ORACLES[name])
    assert (columns, rows) == rows_sorted([d[0] for d in result.description], result.fetchall())
    assert norm(1.0) == 1.0

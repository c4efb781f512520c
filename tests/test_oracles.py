"""Every registered query against its DuckDB statement."""

import duckdb
import pytest

import __spark_entry__ as entry
from energy_fixtures.oracles import oracle_sql as energy_oracles
from energy_fixtures.queries import queries as energy_queries
from tests.conftest import SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(energy_queries()) == set(energy_oracles()) <= set(QUERIES)
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def _by_name(names, found):
    order = sorted(range(len(names)), key=lambda place: names[place])
    return sorted([repr([row[place] for place in order]) for row in found])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, small, name):
    frame = QUERIES[name](spark, small)
    got = [tuple(row) for row in frame.collect()]
    answer = duck.execute(ORACLES[name])
    names = [column[0] for column in answer.description]
    assert sorted(frame.columns) == sorted(names)
    assert got, "an empty result proves nothing"
    assert _by_name(frame.columns, got) == _by_name(names, answer.fetchall())

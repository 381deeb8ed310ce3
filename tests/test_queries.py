"""Every registered query against its SQL, at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from viewflow.plans import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the generated tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def values(table):
    names = sorted(table.column_names)
    return names, sorted(map(repr, zip(*[table[n].to_pylist() for n in names])))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    found = QUERIES[name](spark, DATA).toArrow()
    wanted = database.sql(ORACLES[name]).to_arrow_table()
    types = [{f.name: str(f.type) for f in t.schema} for t in (found, wanted)]
    assert types[0] == types[1]
    assert values(found) == values(wanted)
    assert found.num_rows > 0

"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from tests.compare import differences
from tidegauge.queries import MODULES

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: query for m in MODULES for name, query in m.register.queries.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.register.oracles.items()}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in contract.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_entry(spark):
    assert contract.entry(spark).count() == 11


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert differences(got, db.sql(ORACLES[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0

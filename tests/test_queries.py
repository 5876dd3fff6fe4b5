import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidewire.plans import ORACLES, QUERIES
from tools.check import TABLES, compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, db, name):
    actual = queries()[name](spark, FOLDER).toArrow()
    assert compare(actual, db.sql(oracle_sql()[name]).to_arrow_table()) is None


def test_entry_has_rows_and_a_stable_schema(spark):
    result = entry(spark)
    assert result.columns == ["event_id", "topic", "partition", "offset", "status", "reason", "attempts"]
    assert result.count() > 0

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from contract import oracles, spark_queries
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def tables(small_data):
    connection = duckdb.connect()
    for path in glob.glob(f"{small_data}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert set(spark_queries.QUERIES) == set(oracles.SQL)
    assert set(spark_queries.QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(spark_queries.QUERIES))
def test_query_equals_its_sql(spark, small_data, tables, name):
    found = driver.queries()[name](spark, small_data)
    columns = sorted(found.columns)
    expected = tables.execute(driver.oracle_sql()[name])
    order = [c[0] for c in expected.description]
    assert sorted(order) == columns
    wanted = [tuple(row[order.index(c)] for c in columns) for row in expected.fetchall()]
    assert rows_of(found.select(*columns)) == sorted(wanted, key=repr)


def test_flagship_query(spark):
    lists = driver.entry(spark)
    assert lists.columns == ["user_id", "rank", "item_id", "title", "score"]
    assert lists.count() == 1500

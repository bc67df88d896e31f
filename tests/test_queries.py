"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as driver
from checks import batches, ledgers, merges, plans, scans
from checks.compare import duckdb_rows, duckdb_with, spark_rows

REGISTRIES = [m.registry for m in (scans, batches, merges, ledgers, plans)]
QUERIES = {name: query for r in REGISTRIES for name, query in r.queries.items()}
SQL = {name: sql for r in REGISTRIES for name, sql in r.sql.items()}


@pytest.fixture(scope="module")
def connection(request):
    return duckdb_with("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, connection, sf_dir, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duckdb_rows(connection, SQL[name])


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


def test_entry_has_rows_and_a_stable_schema(spark):
    result = driver.entry(spark)
    assert result.count() == 1500
    assert result.columns[0] == "o_orderkey"

"""Every query with an oracle gives exactly DuckDB's rows and column types."""

import pytest

import __spark_entry__ as driver
from footfall.plans.oracles import ORACLES
from footfall.plans.queries import QUERIES
from tests.compare import connect, duckdb_rows, duckdb_types, spark_rows, spark_types
from tests.conftest import SF_DIR

ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    result = driver.queries()[name](spark, SF_DIR)
    columns, rows = spark_rows(result)
    assert len(set(columns)) == len(columns)
    assert rows
    expected_columns, expected = duckdb_rows(con, driver.oracle_sql()[name])
    assert columns == expected_columns
    assert rows == expected
    assert spark_types(result) == duckdb_types(con, driver.oracle_sql()[name])


@pytest.mark.parametrize("name", ["segment_options", "segment_sizes", "segment_counts_desc"])
def test_ordered_reports_keep_their_order(spark, con, name):
    rows = [tuple(row) for row in driver.queries()[name](spark, SF_DIR).collect()]
    assert rows == con.execute(driver.oracle_sql()[name]).fetchall()


def test_entry_returns_features(spark):
    assert driver.entry(spark).count() == 15

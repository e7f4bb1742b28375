"""Every registered query against its SQL in DuckDB."""

import pytest
from compare import connect, oracle_rows, spark_rows
from conftest import SF_DIR

import __spark_entry__ as entry_points
from rulespark.checks import oracles, queries

QUERIES, ORACLES = queries.all_queries(), oracles.all_oracles()


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, database, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == oracle_rows(database, ORACLES[name])


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["RULE_RUN_ID", "RULE_ID", "HEADER_DATA", "COL1", "COL2", "COL3"]
    assert result.count() == 495

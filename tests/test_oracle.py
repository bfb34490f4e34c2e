"""Every registered query against its DuckDB SQL."""

import pytest
from oracle import connect, differences

import __spark_entry__ as driver
from tallymill.workloads import ORACLES, QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf_dir, con, name):
    frame = driver.queries()[name](spark, sf_dir)
    assert frame.count() > 0
    assert differences(frame, con, driver.oracle_sql()[name]) == ""


def test_comparison_notices_a_wrong_cell(spark, con):
    frame = spark.sql("SELECT 1 AS a, 'x' AS b UNION ALL SELECT 2, 'y'")
    assert differences(frame, con, "SELECT 1 AS a, 'x' AS b UNION ALL SELECT 2, 'y'") == ""
    assert differences(frame, con, "SELECT 1 AS a, 'x' AS b UNION ALL SELECT 2, 'z'")
    assert differences(frame, con, "SELECT 1 AS a, 'x' AS b")
    assert differences(frame, con, "SELECT 1 AS a, 'x' AS c UNION ALL SELECT 2, 'y'")


def test_entry(spark):
    assert driver.entry(spark).count() == 24

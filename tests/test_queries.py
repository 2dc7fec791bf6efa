"""Every registered query against its SQL, on the smallest data set."""

import re
from pathlib import Path

import pytest
from check import compare, duck

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
# the training-data operators have their own tests in tests/llm
QUERIES, ORACLES = (
    {k: v for k, v in d.items() if k != "pipeline" and not re.match(r"op\d+_", k)}
    for d in (driver.queries(), driver.oracle_sql())
)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, message, rows = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert ok, message


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert driver.entry(spark).count() > 0

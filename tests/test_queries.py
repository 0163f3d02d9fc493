"""Every registered query against DuckDB on the driver's tables."""

import re

import pytest

import __spark_entry__ as contract
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
#: Queries of the pipeline's operators have their tests beside them.
QUERIES = {k: q for k, q in contract.queries().items() if not re.match(r"op\d+_", k) and k != "pipeline"}
ORACLE = {k: q for k, q in contract.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF), duck, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 16

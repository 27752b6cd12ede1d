"""Every query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as contract
from tests.oracle import compare
from weftgraph.plans import star_schema

FOLDER = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(star_schema.queries()) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("key", sorted(star_schema.queries()))
def test_query(spark, key):
    rows, problem = compare(spark, FOLDER, contract.queries()[key], contract.oracle_sql()[key])
    assert problem == ""
    assert rows > 0


def test_entry(spark):
    assert contract.entry(spark).columns == ["nation_id", "orders"]

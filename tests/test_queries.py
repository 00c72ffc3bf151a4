import pytest

import __spark_entry__ as contract
from modelvigil.plans import registry
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [r.day for r in sorted(rows, key=lambda r: r.day)] == list(range(7, 30))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    problem = differences(spark, con, SF, registry.QUERIES[name], registry.ORACLES[name])
    assert problem is None, problem

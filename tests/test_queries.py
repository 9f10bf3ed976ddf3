"""Every registered query against its SQL on the smallest data set."""

import pytest
from compare import database, differences

from tidemart import oracle, registry

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(ROOT)


@pytest.mark.parametrize("name", list(registry.registered()))
def test_query_matches_sql(spark, con, name):
    assert differences(spark, con, ROOT, name) == []


def test_every_query_has_sql():
    assert set(registry.registered()) == set(oracle.statements())


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    # The optional queries may be without SQL.
    assert set(registry.registered()) <= set(contract.oracle_sql()) <= set(contract.queries())

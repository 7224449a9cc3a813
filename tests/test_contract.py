"""Every query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as contract
from compare import differences, open_oracle

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(DATA)


CATALOG = contract.catalog.QUERIES


def test_every_query_has_sql():
    assert set(CATALOG) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, oracle, name):
    got = contract.queries()[name](spark, DATA).toPandas()
    assert differences(got, oracle.execute(contract.oracle_sql()[name]).df()) == ""


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() > 0

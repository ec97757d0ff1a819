"""Every registered query against its SQL on the whole small tables."""

import oracle
import pytest
from workcal.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    assert oracle.differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


def test_entry(spark):
    import __spark_entry__ as contract

    assert set(contract.queries()) >= set(QUERIES)
    assert set(contract.oracle_sql()) >= set(SQL)
    assert contract.entry(spark).count() > 0

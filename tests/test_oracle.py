"""Every registered query: against its SQL where it has one, else that it yields rows."""

import os

import pytest

from checks import QUERIES, SQL
from checks.compare import connect, difference
from tests.conftest import SF

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_yields_rows(spark, name):
    """Every column is computed, which counting rows alone would skip."""
    df = QUERIES[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns)
    df.write.format("noop").mode("overwrite").save()
    assert not df.isEmpty()


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())

"""Every registered query against its SQL, on the smallest test tables."""

import os

import pytest

from brindle.plans import registered
from compare import difference, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
CATALOG = registered()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(CATALOG.oracles))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, CATALOG.plans[name], CATALOG.oracles[name], SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(CATALOG.plans) - set(CATALOG.oracles)))
def test_query_without_sql_gives_rows(spark, name):
    assert CATALOG.plans[name](spark, SF_DIR).count() > 0


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0

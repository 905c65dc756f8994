"""Every query against its SQL counterpart on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from chatloom import plans
from oracle import compare, database

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, con, name):
    problem, _, _ = compare(spark, con, name, plans.QUERIES[name], plans.ORACLE.get(name), SF)
    assert problem is None, problem


def test_every_query_has_sql():
    assert set(plans.QUERIES) == set(plans.ORACLE)
    assert set(plans.QUERIES) <= set(entry.queries())
    assert set(plans.ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0

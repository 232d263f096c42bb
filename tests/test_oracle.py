"""Every query against its SQL twin, over whole tables."""

import os

import pytest

from listenhouse.oracle import ORACLE
from listenhouse.registry import QUERIES
from tests.compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) == ""


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 600

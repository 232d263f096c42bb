"""Queries that SQL can express, over whole tables."""

import os

import pytest

from listenhouse.llm.oracle import ORACLE
from listenhouse.llm.queries import QUERIES
from tests.compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) == ""

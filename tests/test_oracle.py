"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from statpanel.plans.oracle import ORACLE
from statpanel.plans.registry import QUERIES
from tests.compare import assert_same, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    n = assert_same(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name])
    assert n > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0

"""Every registered query against its reference SQL on the supplied tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import compare
from millrace.suite.oracle import ORACLE
from millrace.suite.queries import QUERIES

SF = os.environ.get("MILLRACE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_matches_reference(spark, con, name):
    assert compare.differences(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF) == []

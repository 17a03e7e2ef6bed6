"""Every registered query against its SQL counterpart on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry
from docflow.plans.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    from check import connect

    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    from check import compare

    result = compare(spark, con, SF_DIR, name, entry.queries()[name], entry.oracle_sql()[name])
    assert result.startswith("ok"), result

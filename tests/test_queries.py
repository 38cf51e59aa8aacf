"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from railcadence.plans import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(queries.all_queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.all_queries()))
def test_query(spark, con, name):
    ok, note = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR)
    assert ok, note


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["direction", "stop_key", "n_pairs", "avg_excess", "score"]
    assert df.count() == 10

"""Every registered query against its SQL, on the smallest test tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from tests.compare import connect, differences
from tests.helpers import plan
from workload.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = entry_points.queries()[name](spark, SF_DIR)
    assert differences(frame, duck, entry_points.oracle_sql()[name]) == []
    text = plan(frame)
    for unwanted in ("Python", "ArrowEval", "CartesianProduct", "NestedLoopJoin"):
        assert unwanted not in text


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["y", "m", "label", "status", "records"]
    assert result.count() > 0

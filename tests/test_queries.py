"""Every registered query against its SQL in DuckDB, over the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    sql = ORACLES[name]
    assert difference(spark, duck, QUERIES[name], sql, SF_DIR) is None


def test_flagship_has_all_bands(spark):
    bands = {r.partition_gph for r in entry.entry(spark).collect()}
    assert bands <= set(range(10)) and len(bands) > 5

"""Every query of the catalog against its SQL twin on the smallest data."""

from __future__ import annotations

import os

import oracle
import pytest

import __spark_entry__ as entry_module
from martworks.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in ORACLES:
        assert oracle.compare(spark, con, QUERIES[name], ORACLES[name], SF_DIR) is None
    else:
        assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0

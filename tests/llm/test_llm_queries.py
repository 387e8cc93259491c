"""The registered training-data queries: SQL twins, row counts and plans."""

from __future__ import annotations

import re

import oracle
import pytest

from martworks.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
NATIVE = ("op6_", "op9_", "op10_")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in ORACLES:
        assert oracle.compare(spark, con, QUERIES[name], ORACLES[name], SF) is None
        return
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    if name.startswith(NATIVE):
        assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow", plan)
    assert df.count() > 0

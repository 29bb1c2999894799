"""Every query with a SQL counterpart gives the same rows in both engines."""

import compare
import pytest

from tickermood.plans.catalog import QUERIES
from tickermood.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"
# Too few days for sequences there.
LARGER = {"history_files": "/root/testdata/sf0.01", "sequence_moments": "/root/testdata/sf0.01"}

# Joins that compare every row with every other, and Python in the data path.
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_every_counterpart_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, LARGER.get(name, SF))
    columns, found = compare.spark_rows(df)
    tables = compare.connect(LARGER[name]) if name in LARGER else duck
    expected_columns, expected = compare.oracle_rows(tables, ORACLE[name])
    assert columns == expected_columns
    assert found == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in UNWANTED if word in plan]

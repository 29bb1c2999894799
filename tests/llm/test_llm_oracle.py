"""Queries with a SQL counterpart, and what holds for all of them."""

import compare
import pytest

from tickermood.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, name):
    df = QUERIES[name](spark, SF)
    assert compare.spark_rows(df) == compare.oracle_rows(compare.connect(SF), ORACLE[name])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in UNWANTED if word in plan]


@pytest.mark.parametrize("name", ["op1_quality_rules", "op5_url_filters", "op8_line_dedup"])
def test_native_operators_run_no_python(spark, name):
    """Also not in the steps that are written on the way."""
    import tickermood.llm.common as common
    import tickermood.llm.line_dedup as line_dedup
    import tickermood.llm.quality_rules as quality_rules

    plans = []

    def spy(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return common.saved(df, label)

    def spy_bucketed(df, *options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return common.bucketed(df, *options)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quality_rules, "saved", spy)
        patch.setattr(line_dedup, "bucketed", spy_bucketed)
        plans.append(QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString())
    assert not [p for p in plans if "Python" in p or "Arrow" in p or "Pandas" in p]


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))

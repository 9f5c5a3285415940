"""Scale properties of every registered query's physical plan."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    # the initial adaptive plan: exchanges included, before runtime refinement
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_plan_is_scale_safe(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "BroadcastExchange" not in plan, plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, plan
    # every aggregate is two-phase: reduced map-side before its shuffle
    finals = re.findall(r"Aggregate\(key=\[[^\]]*\], functions=\[(?!partial_)", plan)
    partials = re.findall(r"Aggregate\(key=\[[^\]]*\], functions=\[partial_", plan)
    assert len(partials) >= len(finals), plan
    # a row_number window is limited map-side (one row per key per task)
    if "Window [row_number()" in plan:
        assert plan.count("WindowGroupLimit") >= 2 and ", Partial" in plan, plan
    # shuffles only on the order key, by range (sorted sink) or where the test
    # set-up deals the rows of a single-split table to all cores
    for kind, first in re.findall(r"(?<!Broadcast)Exchange (\w+)\(([^,)]*)", plan):
        assert kind in ("hashpartitioning", "rangepartitioning"), (kind, first)
        if kind == "hashpartitioning":
            assert first.startswith(("order_id", "_nondeterministic")), (kind, first)


def test_audit_sees_the_keyed_operators(spark):
    plan = _plan(E.queries()["latest_per_key"](spark, SF))
    assert "hashpartitioning(order_id" in plan and "WindowGroupLimit" in plan
    plan = _plan(E.queries()["upsert_snapshot"](spark, SF))
    assert len(re.findall(r"functions=\[partial_max_by", plan)) >= 1
    assert plan.count("Scan parquet") == 2  # the stored snapshot and the batch, once each

"""Plans that matter at scale: one exchange where one is enough, narrow scans. (No products: with the twins.)"""

import re

import pytest

from symgraph.plans import registry


def _plan(spark, data, name):
    return registry.queries()[name](spark, data)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, columns, absent", [("call_fanout", "ref_id", "location"), ("call_sites", "loaded_at", "definition"), ("needs_code_summary", "code_summary", "embedding"), ("call_context", "code_summary", "embedding")])
def test_scans_read_what_is_needed(spark, data, name, columns, absent):
    scans = [x for x in re.findall(r"ReadSchema: struct<(.*)>", _plan(spark, data, name)) if columns in x]
    assert scans and all(absent not in x for x in scans)


def test_snapshots_move_once(spark, data):
    plan = _plan(spark, data, "p2_found")
    assert plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan and "Window" in plan


def test_nested_records_never_move(spark, data):
    assert "Exchange" not in _plan(spark, data, "p4_found")

"""What the planner makes of the registered queries."""

import pytest

import __spark_entry__ as registered
from checks.queries import QUERIES
from tests.plan import planned

FOLDER = "/root/testdata/sf0.001"
PYTHON = ("PythonUDF", "EvalPython", "InPandas", "InArrow")


@pytest.fixture(scope="module")
def plans(spark):
    return {name: planned(registered.queries()[name](spark, FOLDER)) for name in QUERIES}


def test_no_python_and_no_cross_join(plans):
    for name, plan in plans.items():
        assert not any(word in plan for word in PYTHON), name
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_anti_join(plans):
    for name in ("live_rows", "latest_live"):
        assert "LeftAnti" in plans[name] and "LeftOuter" not in plans[name]


@pytest.mark.parametrize("name", ["latest_per_key", "latest_live", "quality_report"])
def test_latest_is_limited_before_the_shuffle(plans, name):
    plan = plans[name]
    final, partial = plan.index("row_number(), 1, Final"), plan.index("row_number(), 1, Partial")
    assert final < plan.index("Exchange hashpartitioning", final) < partial


def test_row_wise_queries_do_not_shuffle(plans):
    row_wise = (
        "epoch_to_text flatten_payload message_envelope null_to_default project_rename "
        "register_rows stringify_all union_fill live_rows"
    ).split()
    for name in row_wise:
        assert "hashpartitioning" not in plans[name] and "SinglePartition" not in plans[name], name


def test_scans_are_pruned_and_filtered(plans):
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plans["deleted_keys"]
    assert "EqualTo(l_returnflag,R)" in plans["deleted_keys"]
    assert "IsNotNull(user_id)" in plans["latest_per_key"]


def test_preview_keeps_only_the_first_rows(plans):
    assert "TakeOrderedAndProject" in plans["preview_rows"]


def test_entry(spark):
    rows = registered.entry(spark).collect()
    assert len(rows) == 9 + 10

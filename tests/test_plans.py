"""Physical plans of the registered queries with Spark's own broadcasts turned off."""

import pytest

from tabload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
# Windows without a partition run over one row per partition of a range exchange only.
LANDED = {"stream_ingest_equals_batch", "malformed_split"}  # they write files first
NUMBERED = {"assign_surrogates", "submission_sequence"}
HISTORY = {"version_intervals"}  # its windows hold one key's rows, one for each version of its bucket, and need all of them


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = {name: run(spark, FOLDER) for name, run in QUERIES.items() if name not in LANDED}
        return {name: df._jdf.queryExecution().executedPlan().toString() for name, df in built.items()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("part", ["EvalPython", "MapInPandas", "NestedLoop", "CartesianProduct"])
def test_no_query_has(plans, part):
    assert [name for name, plan in plans.items() if part in plan] == []


def test_only_numbering_and_measured_keys_are_broadcast(plans):
    assert {name for name, plan in plans.items() if "BroadcastExchange" in plan} == NUMBERED | {"delta_versions_few", "resolve_visits"}


def test_group_limits_before_the_shuffle(plans):
    windowed = {name: plan for name, plan in plans.items() if "Window [" in plan and name not in NUMBERED | HISTORY}
    assert windowed and all(plan.count("WindowGroupLimit") >= 2 for plan in windowed.values())


def test_projections_read_only_their_columns(plans):
    assert "html" not in plans["route_by_path"] and "text" not in plans["file_kind_alias"]
    assert "PushedFilters: [IsNotNull(o_orderpriority)" in plans["delta_classify"]


def test_large_deltas_shuffle_each_side_once(plans):
    for name in ("delta_classify", "merge_snapshot", "delta_diff_outer"):
        assert plans[name].count("Exchange hashpartitioning") == 2

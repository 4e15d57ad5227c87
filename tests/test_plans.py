"""Plan-shape guards for every batch query: no cartesian product, no
nested-loop join, no row-at-a-time Python UDF; scans read pruned columns."""

import pytest

from gridcat.plans import queries

from conftest import SF_SMALL

# queries that run streams before returning
SIDE_EFFECT = {"stream_job_gate", "stream_new_files", "stream_upsert", "stream_product_gate", "stream_status_dedupe",
               "stream_product_outcomes", "notification_sink", "stream_file_rows"}
BATCH = sorted(set(queries.queries()) - SIDE_EFFECT)
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.mark.parametrize("threshold", ["33554432", "-1"])
@pytest.mark.parametrize("name", BATCH)
def test_plan_shape(spark, name, threshold):
    """With broadcasts, and without any, as between large tables."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = queries.queries()[name](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_scans_are_pruned(spark):
    df = queries.queries()["variable_select"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(event_type" in plan or "PushedFilters: [IsNotNull(event_type)" in plan
    assert "props" not in plan.split("ReadSchema:")[1].split("\n")[0]

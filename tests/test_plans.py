"""Plan shape of every registered query: JVM-side, no pair explosion, pushdown."""

from __future__ import annotations

import re

import pytest

from chartlens.operators import artists, lifecycle
from chartlens.plans import questions as Q
from chartlens.plans.registry import QUERIES
from chartlens.session import fresh_path
from chartlens.sources import chart_rows, read_chart_table, write_chart_table
from tests.conftest import SF_SMALL

# fitted-model tables are built on the driver from the model's own small arrays
MODEL_TABLES = {"feature_importance", "coefficient_table"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODEL_TABLES))
def test_no_python_udf_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    python = ("BatchEvalPython", "ArrowEvalPython", "InPandas", "InArrow", "PythonUDTF")
    for bad in (*python, "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


@pytest.fixture(scope="module")
def table(spark):
    path = fresh_path(spark, "plan-charts")
    write_chart_table(chart_rows(spark, SF_SMALL), path)
    return read_chart_table(spark, path)


def test_streak_aggregates_before_its_first_shuffle(table):
    plan = plan_of(lifecycle.longest_streak(Q.lifecycle_base(table)))
    lines = plan.splitlines()
    first_exchange = max(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    below = "\n".join(lines[first_exchange:])
    assert "partial_count" in below


def test_filters_reach_the_scan(table):
    plan = plan_of(Q.q1_delay(table))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(release_day,2017-01-01\)", plan)
    assert re.search(r"PartitionFilters: \[[^\]]*\(chart#\d+ = top200\)", plan)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(f.split(":")[0] for f in schema.split(",")) == {"track_id", "region", "date", "release_day"}


def test_only_bounded_explicit_broadcasts(table):
    # The only broadcast hint of the artist positions is the per-partition offsets
    # table (one row per range partition); other broadcasts are Spark's own
    # size-checked choices. The tier question takes no positions, so it has no hint at all.
    q4 = Q.q4_spread(table)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in q4
    df = artists.artist_tiers(artists.artist_counts(Q.tier_inputs(table)[0]))
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("strategy=broadcast") == 1
    assert re.search(r"Join Inner, \(_pid#\d+ = _pid#\d+\), rightHint=\(strategy=broadcast\)", optimized)


@pytest.mark.parametrize(
    "name,plan",
    [
        ("q1", Q.q1_delay),
        ("q2", Q.q2_streak),
        ("q3", Q.q3_corridors),
        ("q4", Q.q4_spread),
        ("q6_best", Q.q6_best_genre),
        ("q6_quartiles", Q.q6_quartiles),
    ],
)
def test_headline_plans_have_no_lambda_functions(table, name, plan):
    # higher-order-function lambdas are evaluated outside generated code
    assert "lambdafunction" not in plan_of(plan(table)).lower(), name


def test_model_frame_shuffles_twice(spark, table):
    from chartlens.operators import model

    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        # the plan a large cluster gets: no broadcast, static plan
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = plan_of(model.model_frame(Q.lifecycle_base(table)))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "Join" not in plan and plan.count("FileScan") == 1
    # per-day rows, then the (track, region) window that later steps reuse
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2

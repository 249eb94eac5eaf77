"""Month blocks and counting histograms against plain rules on random data."""

from __future__ import annotations

import datetime as dt
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartlens.functions.histogram import histogram, stats_of
from chartlens.operators import lifecycle, spread
from chartlens.plans import questions as Q
from chartlens.plans.registry import charts_of
from tests.conftest import SF_SMALL

SCHEMA = "track_id string, region string, date date, release_day date"


def random_rows(seed, n=3000):
    """Sparse and dense track-regions, repeated dates, NULL dates and keys, dates across years."""
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        track = int(rng.integers(0, 40))
        span = [20, 70, 400][track % 3]
        day = dt.date(2016, 12, 20) + dt.timedelta(days=int(rng.integers(0, span)))
        rows.append((
            None if track == 39 else f"T{track}", None if rng.random() < 0.01 else f"R{rng.integers(0, 3)}",
            None if rng.random() < 0.05 else day, None if rng.random() < 0.2 else day - dt.timedelta(days=5),
        ))
    return rows + [("lone", "R", None, None), ("lone", "R", None, None), ("old", "R", dt.date(1969, 12, 31), None), ("old", "R", dt.date(1970, 1, 1), None)]


def longest(dates, max_gap):
    days = sorted(d for d in dates if d is not None)
    best = run = 1
    for a, b in zip(days, days[1:]):
        run = run + 1 if (b - a).days <= max_gap else 1
        best = max(best, run)
    return best


def by_key(rows):
    out = {}
    for t, r, d, rel in rows:
        out.setdefault((t, r), []).append((d, rel))
    return out


@pytest.mark.parametrize("max_gap", [0, 1, 3, 10, 30, 31, 45])
def test_streak_is_the_plain_rule(spark, max_gap):
    rows = random_rows(max_gap)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {(r.track_id, r.region): r.days_in_chart for r in lifecycle.longest_streak(df, max_gap).collect()}
    assert got == {k: longest([d for d, _ in v], max_gap) for k, v in by_key(rows).items()}


def test_summary(spark):
    rows = random_rows(50)
    got = lifecycle.track_region_summary(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    want = by_key(rows)
    assert len(got) == len(want)
    for r in got:
        days = [d for d, _ in want[r.track_id, r.region] if d]
        releases = [x for _, x in want[r.track_id, r.region] if x]
        assert (r.first_chart_day, r.chart_entries) == (min(days, default=None), len(days))
        assert (r.release_day, r.days_in_chart) == (min(releases, default=None), longest(days, 3))


def test_blocks_of_new_shards_merge(spark):
    rows = random_rows(60)
    shards = [spark.createDataFrame(rows[i::3], SCHEMA) for i in range(3)]
    merged = lifecycle.merge_month_blocks(*[lifecycle.month_blocks(s) for s in shards])
    whole = lifecycle.month_blocks(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(str, merged.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
    got = {(r.track_id, r.region): r.days_in_chart for r in lifecycle.longest_streak_of_blocks(merged).collect()}
    assert got == {k: longest([d for d, _ in v], 3) for k, v in by_key(rows).items()}


def test_one_row_per_month_is_moved(spark):
    """A month of one run, however many rows it has, is one block and one piece."""
    rows = [("T", "R", dt.date(2020, 1, 1) + dt.timedelta(days=i % 60), None) for i in range(6000)]
    blocks = lifecycle.month_blocks(spark.createDataFrame(rows, SCHEMA))
    assert blocks.count() == 2 == lifecycle.block_pieces(blocks).count()
    assert lifecycle.longest_streak_of_blocks(blocks).first().days_in_chart == 6000


def test_histogram_statistics(spark):
    rng = np.random.default_rng(3)
    rows = [(None if g == 0 else f"g{g}", None if rng.random() < 0.1 else int(rng.integers(-5, 1 + 3 * g))) for g in rng.integers(0, 9, 2000)]
    rows += [("none", None), ("one", 7)]
    hist = histogram(spark.createDataFrame(rows, "g string, v int"), ["g"], "v")
    twice = hist.unionByName(hist)  # a value in several rows
    want = {}
    for g, v in rows:
        want.setdefault(g, []).extend([v] if v is not None else [])
    for h in (hist, twice):
        got = {r["g"]: tuple(r)[1:] for r in stats_of(h, ["g"], "v", "x").collect()}
        assert set(got) == set(want)
        for g, (avg, median, low, high) in got.items():
            v = want[g]
            if not v:
                assert (avg, median, low, high) == (None,) * 4
            else:
                assert (median, low, high) == (statistics.median(v), min(v), max(v)) and abs(avg - statistics.fmean(v)) < 1e-9


def test_both_tier_reports_come_from_one_histogram(spark):
    edges = Q.tier_edges(charts_of(spark, SF_SMALL)).cache()
    hist = spread.edge_histogram(edges)
    for of, direct in ((spread.spread_of, spread.spread_by_destination), (spread.corridors_of, spread.corridor_avg)):
        a, b = of(hist).collect(), direct(edges).collect()
        assert [tuple(r)[:2] for r in a] == [tuple(r)[:2] for r in b]
        assert np.allclose([r[-1] for r in a], [r[-1] for r in b])
    edges.unpersist()


@pytest.mark.parametrize("question", [Q.q1_delay, Q.q2_streak, Q.q4_spread])
def test_medians_without_per_group_maps(spark, question):
    plan = question(charts_of(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan


def test_model_frame_does_not_sort_raw_rows(spark):
    """Raw rows go into a hash aggregation; whole feature rows are compared after the blocks' shuffle only."""
    from chartlens.operators import model

    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        base = Q.lifecycle_base(charts_of(spark, SF_SMALL).repartition(4))
        plan = model.model_frame(base)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    below = plan[plan.rindex("partial_bit_or") :]  # from the partial aggregation down to the scans
    assert "SortAggregate" not in below
    line = next(x for x in plan.splitlines() if "partial_bit_or" in x)
    assert "HashAggregate" in line
    days = base.select("track_id", "region", F.trunc("date", "month")).distinct().count()
    assert lifecycle.month_blocks(base).count() == days

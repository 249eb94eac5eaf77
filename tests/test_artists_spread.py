"""Artist split, tiers, global positions and spread edges on hand-made rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chartlens.functions.ranking import with_global_position
from chartlens.operators import artists, spread
from chartlens.plans import questions as Q


def test_split_trims_and_keeps_empty_pieces(charts):
    c = charts([dict(artist="A, B,,C"), dict(track_id="T2", artist=None)])
    got = sorted((r.track_id, r.artist) for r in artists.explode_artists(c).collect())
    assert got == [("T1", ""), ("T1", "A"), ("T1", "B"), ("T1", "C")]


def tiers_for(spark, counts):
    df = spark.createDataFrame(list(counts.items()), "artist string, n_track_regions long")
    return {r.artist: r.tier for r in artists.artist_tiers(df, partitions=3).collect()}


def test_tiers_put_remainder_in_bottom(spark):
    t = tiers_for(spark, {f"a{i}": 10 - i for i in range(7)})
    assert [t[f"a{i}"] for i in range(7)] == ["top", "top", "middle", "middle", "bottom", "bottom", "bottom"]


def test_tiers_remainder_of_two(spark):
    t = tiers_for(spark, {f"a{i}": 10 - i for i in range(8)})
    assert [t[f"a{i}"] for i in range(8)] == ["top", "top", "middle", "middle"] + ["bottom"] * 4


def test_tiers_break_ties_by_name(spark):
    t = tiers_for(spark, {"b": 5, "a": 5, "c": 5, "d": 1, "e": 1, "f": 1})
    assert t == {"a": "top", "b": "top", "c": "middle", "d": "middle", "e": "bottom", "f": "bottom"}


def test_fewer_than_three_artists_are_bottom(spark):
    assert set(tiers_for(spark, {"a": 3, "b": 1}).values()) == {"bottom"}


@pytest.mark.parametrize("parts", [1, 7, 31])
def test_global_position_equals_row_number(spark, parts):
    rnd = random.Random(parts)
    rows = [(f"k{i:04d}", rnd.randint(0, 20)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(parts)
    order = [F.col("v").desc(), F.col("k")]
    got = {r.k: r.position for r in with_global_position(df, order, partitions=parts).collect()}
    ref = {r.k: r.rn for r in df.withColumn("rn", F.row_number().over(Window.orderBy(*order))).collect()}
    assert got == ref


def test_track_in_two_tiers(spark, charts):
    rows = [dict(track_id="t0", artist="top1, low1")]
    rows += [dict(track_id=f"x{i}", artist="top1", region=f"R{i}") for i in range(5)]
    rows += [dict(track_id=f"y{i}", artist="mid1", region=f"R{i}") for i in range(3)]
    bridge, tiers = Q.tier_inputs(charts(rows))
    got = {(r.track_id, r.tier) for r in artists.tier_tracks(bridge, tiers).collect() if r.track_id == "t0"}
    assert got == {("t0", "top"), ("t0", "bottom")}


def tr_frame(spark, rows):
    return spark.createDataFrame(rows, "track_id string, region string, first_chart_day date").withColumn(
        "first_chart_day", F.col("first_chart_day")
    )


def test_tied_origins_give_edges_both_ways(spark):
    import datetime as dt

    day = dt.date(2017, 1, 1)
    tr = tr_frame(spark, [("t", "X", day), ("t", "Y", day)])
    edges = {(r.from_region, r.to_region, r.days_to_popular)
             for r in spread.days_to_popular(spread.first_arrivals(tr)).collect()}
    assert edges == {("X", "Y", 0), ("Y", "X", 0)}


def test_two_origins_one_edge_to_third_region(spark):
    import datetime as dt

    day = dt.date(2017, 1, 1)
    tr = tr_frame(spark, [("t", "Y", day), ("t", "X", day), ("t", "Z", day + dt.timedelta(days=4))])
    edges = {(r.from_region, r.to_region) for r in spread.first_arrivals(tr).collect()}
    assert ("X", "Z") in edges and ("Y", "Z") not in edges
    assert len([e for e in edges if e[1] == "Z"]) == 1
    assert all(a != b for a, b in edges)


def test_title_days_in_destination_are_averaged(charts):
    rows = [dict(title="s", region="X", date="2017-03-01", af_danceability=0.9, release_date="2017-01-01"),
            dict(title="s", region="Z", date="2017-03-03", af_danceability=0.9, release_date="2017-01-01"),
            dict(title="s", region="Z", date="2017-03-07", af_danceability=0.9, release_date="2017-01-01")]
    out = Q.title_spread(charts(rows)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.from_region, r.to_region, r.edges, r.total_days, r.avg_days_to_popular) == ("X", "Z", 2, 8, 4.0)


def brute_title_spread(rows):
    """Row-by-row edge list of the title question (the reference's join)."""
    first = {}
    for t, day, _ in rows:
        first[t] = min(first.get(t, day), day)
    origins = [(t, reg) for t, day, reg in rows if day == first[t]]
    sums = {}
    for t, o in origins:
        for t2, day, reg in rows:
            if t2 == t and reg != o:
                n, s = sums.get((o, reg), (0, 0))
                sums[(o, reg)] = (n + 1, s + (day - first[t]).days)
    return sums


def test_chart_day_spread_equals_row_join(spark):
    import datetime as dt

    rnd = random.Random(3)
    rows = [(f"s{rnd.randint(0, 8)}", dt.date(2017, 1, 1) + dt.timedelta(days=rnd.randint(0, 12)),
             f"R{rnd.randint(0, 4)}") for _ in range(300)]
    df = spark.createDataFrame(rows, "title string, date date, region string")
    got = {(r.from_region, r.to_region): (r.edges, r.total_days)
           for r in spread.chart_day_spread(spread.title_region_days(df)).collect()}
    assert got == brute_title_spread(rows)


def test_first_arrival_equals_brute_force(spark):
    import datetime as dt

    rnd = random.Random(11)
    rows = {}
    for _ in range(400):
        key = (f"t{rnd.randint(0, 30)}", f"R{rnd.randint(0, 6)}")
        day = dt.date(2017, 1, 1) + dt.timedelta(days=rnd.randint(0, 5))
        rows[key] = min(rows.get(key, day), day)
    tr = tr_frame(spark, [(t, r, day) for (t, r), day in rows.items()])
    got = {(r.track_id, r.to_region): (r.from_region, r.to_date) for r in spread.first_arrivals(tr).collect()}
    want = {}
    for (t, r), day in rows.items():
        f = min(v for (t2, _), v in rows.items() if t2 == t)
        orig = sorted(r2 for (t2, r2), v in rows.items() if t2 == t and v == f and r2 != r)
        if orig:
            want[(t, r)] = (orig[0], day)
    assert got == want


@pytest.mark.parametrize("parts", [1, 7, 31])
@pytest.mark.parametrize("setting", ["spark.sql.exchange.reuse", "spark.sql.adaptive.enabled"])
def test_global_position_does_not_depend_on_the_planner(spark, parts, setting):
    before = spark.conf.get(setting, "true")
    spark.conf.set(setting, "false")
    try:
        df = spark.range(20000).selectExpr("(id * 7919) % 20011 as k", "id as x", "string(id) as y").repartition(5)
        got = with_global_position(df, [F.col("k").desc()], partitions=parts).collect()
    finally:
        spark.conf.set(setting, before)
    order = sorted((r.k for r in got), reverse=True)
    want = {k: i + 1 for i, k in enumerate(order)}
    assert all(r.position == want[r.k] for r in got)


def test_unknown_region_counts_as_first_day(charts):
    from chartlens.operators import lifecycle, spread

    c = charts([
        dict(track_id="T", region=None, date="2017-03-01"),
        dict(track_id="T", region="X", date="2017-03-05"),
        dict(track_id="T", region="Y", date="2017-03-09"),
        dict(track_id="U", region="X", date="2017-03-01"),
        dict(track_id="U", region=None, date="2017-03-02"),
        dict(track_id="U", region="Y", date="2017-03-03"),
    ])
    tr = lifecycle.track_region(c)
    assert [(r.track_id, r.first_region) for r in spread.origins(tr).collect()] == [("U", "X")]
    edges = spread.first_arrivals(tr.select("track_id", "region", "first_chart_day")).collect()
    assert [(r.track_id, r.from_region, r.to_region) for r in edges] == [("U", "X", "Y")]


def title_frame(spark, rows):
    return spark.createDataFrame(rows, "title string, date date, region string")


def plain_title_edges(rows):
    """Every origin row with every chart row of its title in another region."""
    out = []
    for title in {t for t, day, _ in rows if t is not None and day is not None}:
        mine = [(day, region) for t, day, region in rows if t == title and day is not None]
        first = min(day for day, _ in mine)
        starts = [r for day, r in mine if day == first and r is not None]
        out += [(title, o, r, first, day, (day - first).days) for o in starts for day, r in mine if r is not None and r != o]
    return sorted(out)


@pytest.mark.parametrize("side", [1, 3, 1024])
def test_title_edges_are_the_row_join(spark, side):
    rng = random.Random(side)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([None] + [dt.date(2017, 3, x) for x in range(1, 7)]), rng.choice(["X", "Y", "Z", None]))
            for _ in range(150)]
    rows += [("first day nowhere", dt.date(2017, 1, 1), None), ("first day nowhere", dt.date(2017, 1, 2), "X")]
    rows += [("repeated", dt.date(2017, 1, 1), "X")] * 7 + [("repeated", dt.date(2017, 1, 4), "Y")] * 5 + [("alone", dt.date(2017, 1, 1), "X")]
    edges = spread.days_to_popular(spread.title_edges(spread.title_days(title_frame(spark, rows)), side=side))
    assert sorted(tuple(r) for r in edges.collect()) == plain_title_edges(rows)
    assert spread.title_edges(spread.title_days(title_frame(spark, []))).count() == 0


def test_title_edges_are_made_by_many_tasks(spark):
    """Few counted rows that stand for many edges: 3 titles of 400 x 400, in one task before."""
    rows = [(t, dt.date(2017, 1, 1 + i % 2), r) for t in "ABC" for r in "XY" for i in range(400)]
    edges = spread.title_edges(spread.title_days(title_frame(spark, rows)), side=32)
    sizes = [r["count"] for r in edges.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3 * 2 * 200 * 400 and len(sizes) > 4 and max(sizes) < sum(sizes) / 4


@pytest.mark.parametrize("origins, days", [(25, 40), (1, 800)])
def test_title_edges_are_made_by_many_tasks_whichever_side_is_smaller(spark, tmp_path, origins, days):
    """25 origin rows, copied to 1,000 parts each, and few counted chart rows, or the reverse. A side was broadcast
    before; when it was the chart rows, one task made all edges."""
    rows = [(t, f"r{i}", dt.date(2017, 1, 1), 1) for t in "ABC" for i in range(origins)]
    rows += [(t, "there", dt.date(2017, 1, 2) + dt.timedelta(i), 32000 // days) for t in "ABC" for i in range(days)]
    counted = spark.createDataFrame(rows, "title string, region string, date date, n bigint")
    counted.write.parquet(str(tmp_path / "days"))
    edges = spread.title_edges(spark.read.parquet(str(tmp_path / "days")), side=32)
    tasks = edges.groupBy(F.spark_partition_id()).count()
    sizes = [r["count"] for r in tasks.collect()]
    assert sum(sizes) == 3 * (origins * 32000 + origins * (origins - 1)) and len(sizes) > 4 and max(sizes) < sum(sizes) / 4
    # Which side was broadcast hung on the one that was there first, so the plan is looked at too.
    joins = [line for line in tasks._jdf.queryExecution().executedPlan().toString().splitlines() if "Join [" in line and "_o_part" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_title_edges_sum_to_the_corridors(spark):
    rng = random.Random(5)
    rows = [(f"t{rng.randrange(9)}", dt.date(2017, 3, rng.randrange(1, 28)), rng.choice("VWXYZ")) for _ in range(500)]
    df = title_frame(spark, rows)
    edges = spread.days_to_popular(spread.title_edges(spread.title_days(df)))
    got = {(r.from_region, r.to_region): r.avg_days_to_popular for r in spread.corridor_avg(edges, group=()).collect()}
    want = {(r.from_region, r.to_region): r.avg_days_to_popular for r in spread.chart_day_spread(spread.title_region_days(df)).collect()}
    assert got == want


def test_hot_title_is_dealt(spark):
    """A title with a third of all rows and several origin rows: no task has twice the mean of the edges."""
    hot = [("hot", dt.date(2017, 3, 1) + dt.timedelta(i % 300), f"r{i % 37}") for i in range(6000)]
    hot += [("hot", dt.date(2017, 3, 1), "r0")] * 40 + [("hot", dt.date(2017, 4, 1), "r1")] * 2000
    rest = [(f"t{i % 2000}", dt.date(2017, 3, 1) + dt.timedelta(i // 2000), f"r{i % 37}") for i in range(16000)]
    names = ["spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"]
    old = {n: spark.conf.get(n) for n in names}
    try:
        spark.conf.set(names[0], "false")
        spark.conf.set(names[1], "-1")
        edges = spread.title_edges(spread.title_days(title_frame(spark, hot + rest)), side=32)
        tasks = [r["count"] for r in edges.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for n in names:
            spark.conf.set(n, old[n])
    assert sum(tasks) > 300_000 and len(tasks) == 8
    assert max(tasks) < 2 * sum(tasks) / len(tasks)

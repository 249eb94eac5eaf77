"""Rows at given places of a total order, found by refining histograms; tiers by two such rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from chartlens.functions.ranking import split_points
from chartlens.operators import artists
from chartlens.plans import questions as Q
from chartlens.plans.registry import QUERIES
from tests.conftest import SF_SMALL


def ordered(rows):
    return sorted(rows, key=lambda r: (-r[1], r[0] is not None, (r[0] or "").encode()))


@pytest.mark.parametrize("cell,step", [(1, 1), (3, 2), (1000, 2)])
def test_places_in_large_ties(spark, cell, step):
    rnd = random.Random(cell)
    names = {"".join(rnd.choice("ab é𝄞Z") for _ in range(rnd.randint(0, 7))) for _ in range(400)} | {None}
    rows = [(n, rnd.choice([1, 1, 1, 1, 2, 9])) for n in names]
    df = spark.createDataFrame(rows, "name string, v int").repartition(5)
    want = ordered(rows)
    places = [1, 2, len(rows) // 3, 2 * (len(rows) // 3), len(rows) - 1, len(rows)]
    got = split_points(df, "v", "name", lambda n: [F.lit(p) for p in places], cell=cell, step=step)
    assert got == [(want[p - 1][1], want[p - 1][0]) for p in places]


def test_places_that_no_row_has(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1)], "name string, v int")
    assert split_points(df, "v", "name", lambda n: [F.lit(0), n, n + 1]) == [(1, "b")]
    assert split_points(df.where("v > 1"), "v", "name", lambda n: [F.lit(1)]) == []
    one_name = spark.createDataFrame([("a", 1)] * 9, "name string, v int")
    assert split_points(one_name, "v", "name", lambda n: [n], cell=2) == [(1, "a")]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 30, 31])
def test_tiers_by_count_are_those_of_the_positions(spark, n):
    rnd = random.Random(n)
    rows = [(f"a{rnd.random()}", rnd.randint(1, 3)) for _ in range(n)]
    df = spark.createDataFrame(rows, "artist string, n_track_regions long")
    want = {(r.artist, r.tier) for r in artists.artist_tiers(df, partitions=3).collect()}
    assert {(r.artist, r.tier) for r in artists.tiers_by_count(df).collect()} == want
    assert {a for a, _ in want} == {a for a, _ in rows}


def test_a_nameless_artist_is_first_among_equals(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("b", 1)], "artist string, n_track_regions long")
    got = {r.artist: r.tier for r in artists.tiers_by_count(df).collect()}
    assert got == {None: "top", "a": "middle", "b": "bottom"}


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_the_tier_question_sorts_and_writes_no_artists(spark, monkeypatch, aqe):
    wrote = []
    plain = Q.materialize
    monkeypatch.setattr(Q, "materialize", lambda df, name="table": wrote.append(name) or plain(df, name))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        tiers = QUERIES["tiers_by_count"](spark, SF_SMALL)
        plan = tiers._jdf.queryExecution().executedPlan().toString()
        rows = {(r.artist, r.tier) for r in tiers.collect()}
        assert wrote == ["tier-bridge"]
        assert "rangepartitioning" not in plan and "Window" not in plan and "Join" not in plan
        assert rows == {(r.artist, r.tier) for r in QUERIES["artist_tiers"](spark, SF_SMALL).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)

"""Property checks against plain statements of the rules (hypothesis)."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chartlens.operators import artists, lifecycle
from tests.test_lifecycle import python_rule

DAY0 = dt.date(2017, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

groups = st.lists(st.lists(st.integers(0, 40), min_size=1, max_size=30), min_size=1, max_size=12)


@SETTINGS
@given(groups)
def test_streak_equals_rule(charts, offsets):
    rows, want = [], {}
    for g, days in enumerate(offsets):
        dates = [DAY0 + dt.timedelta(days=x) for x in days]
        want[f"t{g}"] = python_rule(dates)
        rows += [dict(track_id=f"t{g}", date=d) for d in dates]
    got = {r.track_id: r.days_in_chart for r in lifecycle.longest_streak(charts(rows)).collect()}
    assert got == want


@SETTINGS
@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.integers(1, 9), min_size=1, max_size=25))
def test_tiers_are_thirds_of_the_ranking(spark, counts):
    df = spark.createDataFrame(list(counts.items()), "artist string, n_track_regions long")
    got = {r.artist: r.tier for r in artists.artist_tiers(df, partitions=4).collect()}
    order = sorted(counts, key=lambda a: (-counts[a], a))
    s = len(order) // 3
    want = {a: "top" if i < s else "middle" if i < 2 * s else "bottom" for i, a in enumerate(order)}
    assert got == want


@SETTINGS
@given(st.lists(st.text("AB ,\t", max_size=12), min_size=1, max_size=40))
def test_artist_split_equals_trim_of_each_piece(spark, texts):
    # plain statement of the rule: split on ',' and trim spaces from each piece
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, artist string")
    got = {}
    for r in artists.explode_artists(df).collect():
        got.setdefault(r.i, []).append(r.artist)
    want = {i: [p.strip(" ") for p in t.split(",")] for i, t in enumerate(texts)}
    assert got == want

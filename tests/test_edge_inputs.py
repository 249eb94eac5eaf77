"""Empty input and NULL keys through every question plan."""

from __future__ import annotations

import pytest

from chartlens.operators import genres, spread
from chartlens.plans import questions as Q
from chartlens.schema import CHART_SCHEMA
from chartlens.sources import typed_charts

PLANS = {
    "q1": Q.q1_delay,
    "q2": Q.q2_streak,
    "q3": Q.title_spread,
    "q4_spread": Q.q4_spread,
    "q4_corridors": Q.q4_corridors,
    "q6_best": Q.q6_best_genre,
    "q6_quartiles": Q.q6_quartiles,
    "genre_pivot": lambda c: genres.genre_pivot(Q.genre_rows(c)),
    "genre_spread": lambda c: genres.genre_spread(genres.genre_adoption(Q.genre_rows(c))),
    "title_origins": lambda c: spread.title_origins(spread.title_region_days(Q.title_rows(c))),
    "funnel": Q.funnel,
}


@pytest.mark.parametrize("name", sorted(PLANS))
def test_empty_input(spark, name):
    empty = typed_charts(spark.createDataFrame([], CHART_SCHEMA))
    rows = PLANS[name](empty).collect()
    if name == "funnel":
        assert all(r.row_count == 0 for r in rows)
    else:
        assert rows == []


def test_null_keys_do_not_make_edges_or_fail(charts):
    base = dict(release_date="2017-02-01", af_danceability=0.9, af_energy=0.9)
    c = charts([
        dict(base, track_id="t", region="X", date="2017-03-01"),
        dict(base, track_id="t", region="Y", date="2017-03-02"),
        dict(base, track_id=None, region="Y", date="2017-03-01"),
        dict(base, track_id="t", region=None, date="2017-03-01"),
        dict(base, track_id="t", region="Z", date=None),
        dict(base, track_id="u", region="X", date="2017-03-01", title=None),
        dict(base, track_id="v", region="X", date="2017-03-01", artist=None),
    ])
    edges = {(r.track_id, r.from_region, r.to_region) for r in Q.tier_edges(c).collect()}
    assert ("t", "X", "Y") in edges
    assert all(None not in e for e in edges)
    assert all(r.from_region and r.to_region for r in Q.title_spread(c).collect())
    for name, plan in PLANS.items():
        plan(c).collect()  # every plan runs on NULL keys

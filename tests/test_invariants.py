"""Golden invariants and partitioning independence of the reports."""

from __future__ import annotations

import math

import pytest

from chartlens.plans import questions as Q
from chartlens.plans.registry import charts_of
from chartlens.sources import read_charts, read_report, write_report
from chartlens.sources.charts import typed_charts
from tests.conftest import SF_SMALL


def rows(df):
    def norm(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v

    return sorted(tuple(norm(v) for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def c(spark):
    return charts_of(spark, SF_SMALL).cache()


REPORTS = {
    "q1": lambda c: Q.q1_delay(c),
    "q2": lambda c: Q.q2_streak(c),
    "q3": lambda c: Q.title_spread(c),
    "q4": lambda c: Q.q4_spread(c),
    "q4_corridors": lambda c: Q.q4_corridors(c),
    "q6": lambda c: Q.q6_best_genre(c, "long_date"),
}


@pytest.mark.parametrize("parts", [1, 7, 31])
@pytest.mark.parametrize("name", sorted(REPORTS))
def test_reports_do_not_depend_on_partitioning(c, name, parts):
    assert rows(REPORTS[name](c.repartition(parts))) == rows(REPORTS[name](c))


def test_golden_invariants(c):
    q1 = Q.q1_delay(c).collect()
    assert all(r.min_days_until_chart >= 0 for r in q1)
    avgs = [r.avg_days_until_chart for r in q1]
    assert avgs == sorted(avgs, reverse=True)
    q2 = Q.q2_streak(c).collect()
    assert all(r.min_days_in_chart >= 1 for r in q2)
    edges = Q.tier_edges(c).collect()
    assert edges and all(r.from_region != r.to_region for r in edges)
    assert all(r.days_to_popular >= 0 for r in edges)
    assert all(r.from_region != r.to_region for r in Q.title_spread(c).collect())


def test_origin_date_equals_edge_from_date(c):
    from chartlens.operators import spread

    origins = {r.track_id: r.first_date for r in spread.origins(Q.track_regions_with_artists(c)).collect()}
    for r in Q.tier_edges(c).collect():
        assert origins[r.track_id] == r.from_date


def test_csv_source_reads_dirty_release_dates(spark, tmp_path):
    p = tmp_path / "p_1.csv"
    header = ("track_id,title,artist,region,chart,rank,date,release_date,explicit,af_danceability,af_energy,"
              "af_key,af_loudness,af_mode,af_speechiness,af_acousticness,af_instrumentalness,af_liveness,"
              "af_valence,af_tempo,af_time_signature")
    lines = [header,
             't1,S,"A, B",France,top200,3,2017-03-01,2017,False,0.8,0.8,1.0,-5.0,1.0,0.1,0.1,0.0,0.1,0.5,120.0,4.0',
             "t2,S,C,Japan,viral50,7,2017-03-02,0000,True,0.5,0.5,2.0,-6.0,0.0,0.1,0.1,0.0,0.1,0.5,99.0,4.0",
             "t3,S,,Japan,top200,,2017-03-02,,,,,,,,,,,,,,"]
    p.write_text("\n".join(lines) + "\n")
    df = typed_charts(read_charts(spark, str(tmp_path / "p_*.csv")))
    got = {r.track_id: (r.artist, str(r.release_day), r.rank) for r in df.collect()}
    assert got == {"t1": ("A, B", "2017-01-01", 3), "t2": ("C", "None", 7), "t3": (None, "None", None)}


def test_report_round_trip(spark, c, tmp_path):
    rep = Q.q1_delay(c)
    path = str(tmp_path / "question1")
    write_report(rep, path)
    assert rows(read_report(spark, path, rep.schema)) == rows(rep)

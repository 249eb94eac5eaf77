"""Release typing, cutoffs, streak rule and the Q1/Q2 reports on hand-made rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from chartlens.functions.dates import release_day
from chartlens.operators import clean, lifecycle
from chartlens.plans import questions as Q
from tests.conftest import d


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("2017-02-03", d("2017-02-03")),
        ("2017", d("2017-01-01")),
        ("2017-02", d("2017-02-01")),
        ("0000", None),
        (None, None),
        ("junk", None),
        ("2017-13-45", None),
        (" 2017", d("2017-01-01")),
        ("2017-1-5", d("2017-01-05")),
        ("2017-02-30", None),
        ("2017-02-03T10:00", d("2017-02-03")),
        ("", None),
        ("17", None),
        ("2017-13", None),
    ],
)
def test_release_day_typing(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "release_date string")
    assert df.select(release_day("release_date").alias("r")).first().r == expected


def test_cutoff_exclusive_and_inclusive(charts):
    c = charts([dict(track_id="a", release_date="2017"), dict(track_id="b", release_date="2017-01-02"),
                dict(track_id="c", release_date="0000"), dict(track_id="e", release_date=None)])
    excl = {r.track_id for r in clean.released_after(c).collect()}
    incl = {r.track_id for r in clean.released_after(c, inclusive=True).collect()}
    assert excl == {"b"}
    assert incl == {"a", "b"}


def streak_of(charts, dates):
    rows = [dict(date=x) for x in dates] or [dict(date=None)]
    out = lifecycle.longest_streak(charts(rows)).collect()
    assert len(out) == 1
    return out[0].days_in_chart


@pytest.mark.parametrize(
    "dates,expected",
    [
        (["2017-01-01", "2017-01-04"], 2),  # gap of exactly 3 days continues
        (["2017-01-01", "2017-01-05"], 1),  # gap of 4 breaks
        (["2017-01-01", "2017-01-01", "2017-01-02"], 3),  # repeated date counts
        (["2017-01-01"], 1),
        ([], 1),  # only a row without date
        (["2017-01-01", "2017-01-02", "2017-01-03", "2017-02-01", "2017-02-02"], 3),
    ],
)
def test_streak_cases(charts, dates, expected):
    assert streak_of(charts, dates) == expected


def python_rule(dates):
    """The streak rule written out over a sorted date list (for comparison)."""
    if len(dates) < 2:
        return 1
    ds = sorted(dates)
    best = cur = 1
    for a, b in zip(ds, ds[1:]):
        cur = cur + 1 if (b - a).days < 4 else 1
        best = max(best, cur)
    return best


def test_streak_matches_rule_on_random_groups(charts):
    rnd = random.Random(7)
    rows, expected = [], {}
    for t in range(40):
        n = rnd.randint(1, 25)
        dates = [dt.date(2017, 1, 1) + dt.timedelta(days=rnd.randint(0, 60)) for _ in range(n)]
        expected[f"t{t}"] = python_rule(dates)
        rows += [dict(track_id=f"t{t}", date=x) for x in dates]
    got = {r.track_id: r.days_in_chart for r in lifecycle.longest_streak(charts(rows)).collect()}
    assert got == expected


def test_release_after_first_chart_day_dropped_in_q1_kept_in_q2(charts):
    c = charts([
        dict(track_id="late", region="X", release_date="2017-05-01", date="2017-03-01"),
        dict(track_id="ok", region="X", release_date="2017-02-01", date="2017-03-01"),
    ])
    q1 = Q.q1_delay(c).collect()
    assert len(q1) == 1 and q1[0].max_days_until_chart == 28 and q1[0].min_days_until_chart == 28
    streaks = lifecycle.longest_streak(Q.lifecycle_base(c))
    assert {r.track_id for r in streaks.collect()} == {"late", "ok"}


def test_viral_rows_excluded(charts):
    c = charts([dict(chart="viral50"), dict(track_id="T2")])
    assert [r.track_id for r in Q.lifecycle_base(c).collect()] == ["T2"]


def test_delay_report_order_and_median(charts):
    rows = []
    for i, delay in enumerate([1, 2, 3, 10]):
        rows.append(dict(track_id=f"a{i}", region="A", release_date="2017-02-01",
                         date=(d("2017-02-01") + dt.timedelta(days=delay)).isoformat()))
    rows.append(dict(track_id="b", region="B", release_date="2017-02-01", date="2017-02-02"))
    out = Q.q1_delay(charts(rows)).collect()
    assert [r.region for r in out] == ["A", "B"]
    assert out[0].median_days_until_chart == 2.5 and out[0].avg_days_until_chart == 4.0


def test_peak_rank_is_minimum(charts):
    c = charts([dict(rank=5), dict(rank=2, date="2017-03-02"), dict(rank=None, date="2017-03-03")])
    assert lifecycle.peak_rank(c).first().highest_ranking == 2


def test_filter_funnel_counts_match_separate_counts(charts):
    c = charts([dict(chart="viral50"), dict(release_date="2016-05-01"), dict(), dict(release_date=None)])
    f = {(r.level, r.step_no): r.row_count for r in Q.funnel(c).collect()}
    assert f[("rows", 0)] == 4
    assert f[("rows", 1)] == clean.keep_chart(c).count() == 3
    assert f[("rows", 2)] == Q.lifecycle_base(c).count() == 1
    assert f[("track_regions", 0)] == 1


def test_null_release_fails_valid_release(charts):
    tr = lifecycle.track_region(charts([dict(release_date=None)]))
    assert clean.valid_release(tr).count() == 0
    assert tr.select(F.col("release_day").isNull().alias("n")).first().n


def test_summary_gives_the_same_reports(spark):
    from chartlens.plans.registry import charts_of
    from tests.conftest import SF_SMALL

    c = charts_of(spark, SF_SMALL)
    delay, streak = Q.q1_q2(c)
    assert delay.collect() == Q.q1_delay(c).collect()
    assert streak.collect() == Q.q2_streak(c).collect()
    summary = lifecycle.track_region_summary(Q.lifecycle_base(c))
    tr = lifecycle.track_region(Q.lifecycle_base(c)).join(lifecycle.longest_streak(Q.lifecycle_base(c)),
                                                            ["track_id", "region"])
    cols = ["track_id", "region", "release_day", "first_chart_day", "chart_entries", "days_in_chart"]
    assert sorted(summary.select(cols).collect()) == sorted(tr.select(cols).collect())


def test_release_typing_agrees_with_oracle_sql(spark):
    import duckdb

    from chartlens.plans.oracle import RELEASE_DAY_SQL

    vals = ["2017", "2017-02", "2017-02-03", "0000", " 2017", "2017-1-5", "junk", "2017-02-30",
            "2017-02-03T10:00", "2017-02-03 10:00:00", "", "17", "2017-13", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = {r.v: r.r for r in df.select("v", release_day("v").alias("r")).collect()}
    sql = f"select release_date, {RELEASE_DAY_SQL} from (select unnest(?) as release_date)"
    want = dict(duckdb.connect().execute(sql, [vals]).fetchall())
    assert got == want

"""Write the reports of each question from one chart table.

These are the batch jobs a user runs. All reports together scan the chart rows five times:
once for the track-region summary of the delay, streak and model questions, once for
the tier bridge, once for the title corridors, and twice for the genres (statistics, and
the annotated rows themselves). Each question writes its small intermediate to
the shared folder and derives its reports (CSV with header) from it; funnels
are counted by the same jobs (``operators.counters``).
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlens.operators import clean, genres, model, spread
from chartlens.plans import questions as Q
from chartlens.schema import TIER_ORIGINS, TIERS, TITLE_ORIGINS
from chartlens.session import scratch
from chartlens.sources.charts import write_report


# Report folder names, as the reference names its outputs
# ({tier} is top, middle or bottom; {origin} is the origin's name below).
REPORT_NAMES = {
    "funnel": "filter_funnel",
    "delay": "question1",
    "streak": "question2",
    "tier_funnel": "tier_funnel",
    "tier_spread": "artist_popularity_{tier}",
    "tier_corridor": "{origin}_{tier}",
    "title_corridor": "{origin}",
    "genre_rows": "genre_rows",
    "region_count": "region_count",
    "best_genre": "best_genres_per_month_per_region",
    "genre_counts": "records_per_genre_per_month_per_country",
    "genre_pivot": "popularity_per_genre_per_country",
    "genre_spread": "migration_speed_per_genre",
    "genre_share": "genre_share_per_country",
    "quartile_leaders": "top_genre_per_quartile",
    "forest_metrics": "forest_metrics",
    "linear_metrics": "linear_metrics",
    "importances": "rf_feature_importances",
    "coefficients": "linear_coefficients",
    "formula": "linear_formula",
    "model_funnel": "model_funnel",
}


# Origin names in report folder names.
TIER_ORIGIN_NAMES = {"France": "france", "Japan": "Japan", "United Kingdom": "UK"}
TITLE_ORIGIN_NAMES = {
    "Luxembourg": "luxembourg",
    "France": "france",
    "Dominican Republic": "dominican_republic",
    "Japan": "japan",
    "United Kingdom": "united_kingdom",
}


class _Out:
    def __init__(self, out_dir: str, fmt: str):
        self.base, self.fmt, self.written = out_dir.rstrip("/"), fmt, []

    def put(self, df: DataFrame, name: str) -> None:
        path = f"{self.base}/{name}"
        write_report(df, path, self.fmt)
        self.written.append(path)


class _Shared:
    """What several questions of one call read: made once, by the first that asks."""

    def __init__(self, charts: DataFrame, questions: Sequence[str]):
        self._charts, self._features = charts, "model" in questions
        self._lock, self._lifecycle = threading.Lock(), None

    def lifecycle(self) -> tuple[DataFrame, DataFrame]:
        """``Q.lifecycle_summary``, with features where the model question is asked too."""
        with self._lock:
            if self._lifecycle is None:
                self._lifecycle = Q.lifecycle_summary(self._charts, self._features)
            return self._lifecycle


def delay_and_streak(charts: DataFrame, out: _Out, shared: _Shared, **_) -> None:
    """Q1 and Q2 reports and their funnel, from the one scan of the lifecycle summary."""
    summary, funnel = shared.lifecycle()
    out.put(funnel, REPORT_NAMES["funnel"])
    delay, streak = Q.delay_and_streak_of(summary)
    out.put(delay, REPORT_NAMES["delay"])
    out.put(streak, REPORT_NAMES["streak"])


def tier_spread(charts: DataFrame, out: _Out, **_) -> None:
    """Q4: spread per tier, and corridors from the reference's origins per tier.

    The edges are aggregated once, to a histogram of days per tier and corridor; it is written,
    both kinds of reports derive from it, and the 12 reports are read from the two small tables.
    """
    edges, funnel = Q.tier_question(charts)
    hist = Q.materialize(spread.edge_histogram(edges), "tier-histogram")
    out.put(funnel(), REPORT_NAMES["tier_funnel"])
    spread4 = Q.materialize(spread.spread_of(hist), "tier-spread")
    corridors4 = Q.materialize(spread.corridors_of(clean.from_origin(hist, TIER_ORIGINS)), "tier-corridors")
    for tier in TIERS:
        name = REPORT_NAMES["tier_spread"].format(tier=tier)
        rows = spread4.where(spread4.tier == tier).drop("tier")
        out.put(rows.orderBy(F.desc("avg_days_until_chart"), "to_region"), name)
        for origin in TIER_ORIGINS:
            rows = corridors4.where((corridors4.tier == tier) & (corridors4.from_region == origin))
            name = REPORT_NAMES["tier_corridor"].format(origin=TIER_ORIGIN_NAMES[origin], tier=tier)
            out.put(rows.select("to_region", "avg_days_to_popular").orderBy("avg_days_to_popular", "to_region"), name)


def title_spread(charts: DataFrame, out: _Out, **_) -> None:
    """Q3: rounded corridor means from the reference's five origins.

    The corridor sums (at most regions x regions rows) are written once.
    """
    sums = Q.materialize(Q.title_spread(charts), "title-corridors")
    corridors3 = spread.corridor_avg_rounded(clean.from_origin(sums, TITLE_ORIGINS))
    for origin in TITLE_ORIGINS:
        rows = corridors3.where(corridors3.from_region == origin)
        name = REPORT_NAMES["title_corridor"].format(origin=TITLE_ORIGIN_NAMES[origin])
        out.put(rows.select("to_region", "avg_days_to_popular"), name)


def genre_reports(charts: DataFrame, out: _Out, genre_date: str = "date", **_) -> None:
    """Q6: genre-annotated rows, leaders, counts, pivot, adoption speed, shares, quartile leaders.

    The annotated rows are one scan; every other report derives from the per
    (region, month, genre) statistics, written once.
    """
    stats = Q.materialize(genres.genre_month_stats(Q.genre_rows(charts, genre_date)), "genre-month-stats")
    counts = stats.select("region", "month", "genre", "record_count")
    shares = genres.genre_share(counts)
    best = Q.materialize(genres.best_genre(stats), "best-genre")
    out.put(Q.annotated_rows(charts, genre_date), REPORT_NAMES["genre_rows"])
    out.put(best, REPORT_NAMES["best_genre"])
    out.put(genres.region_count(best), REPORT_NAMES["region_count"])
    out.put(counts, REPORT_NAMES["genre_counts"])
    out.put(genres.genre_pivot(counts), REPORT_NAMES["genre_pivot"])
    out.put(genres.genre_spread(genres.genre_adoption(counts)), REPORT_NAMES["genre_spread"])
    out.put(shares, REPORT_NAMES["genre_share"])
    out.put(genres.top_genre_per_quartile(genres.share_quartile(shares)), REPORT_NAMES["quartile_leaders"])


def model_reports(charts: DataFrame, out: _Out, shared: _Shared, **_) -> None:
    """Q5: forest and linear metrics, importances, coefficients, formula and the funnel, from the lifecycle summary."""
    data, funnel = Q.model_question(charts, shared.lifecycle())
    forest, forest_pred = Q.q5_forest(charts, data)
    linear, linear_pred = Q.q5_linear(charts, data)
    out.put(model.regression_metrics(forest_pred), REPORT_NAMES["forest_metrics"])
    out.put(model.regression_metrics(linear_pred), REPORT_NAMES["linear_metrics"])
    out.put(model.feature_importance(forest), REPORT_NAMES["importances"])
    out.put(model.coefficient_table(linear), REPORT_NAMES["coefficients"])
    out.put(model.formula(linear), REPORT_NAMES["formula"])
    out.put(funnel, REPORT_NAMES["model_funnel"])


QUESTIONS: dict[str, Callable[..., None]] = {
    "delay_streak": delay_and_streak,
    "tiers": tier_spread,
    "titles": title_spread,
    "genres": genre_reports,
    "model": model_reports,
}


def write_reports(
    charts: DataFrame,
    out_dir: str,
    questions: Sequence[str] = tuple(QUESTIONS),
    genre_date: str = "date",
    fmt: str = "csv",
    parallel: bool = True,
) -> list[str]:
    """Write the reports of the chosen questions; returns the paths written.

    The questions are independent, so with ``parallel`` each one submits
    its jobs from its own driver thread to the same session; the scheduler
    then runs their stages side by side instead of one question after the
    other (useful when one question's stages do not fill the cluster).
    Tables written on the way are removed at the end.
    """
    spark, shared = charts.sparkSession, _Shared(charts, questions)
    with scratch(spark) as folder:

        def run(q: str) -> list[str]:
            with scratch(spark, folder):
                out = _Out(out_dir, fmt)
                QUESTIONS[q](charts, out, genre_date=genre_date, shared=shared)
                return out.written

        if not parallel or len(questions) < 2:
            return [p for q in questions for p in run(q)]

        def described(q: str) -> list[str]:
            spark.sparkContext.setJobDescription(f"chartlens report: {q}")
            return run(q)

        with ThreadPoolExecutor(max_workers=len(questions)) as pool:
            return [p for paths in pool.map(described, questions) for p in paths]


def write_all_reports(
    charts: DataFrame, out_dir: str, genre_date: str = "date", models: bool = True, parallel: bool = True
) -> list[str]:
    """Write every question's reports under ``out_dir``."""
    qs = [q for q in QUESTIONS if models or q != "model"]
    return write_reports(charts, out_dir, qs, genre_date, parallel=parallel)

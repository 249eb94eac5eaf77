"""Cleaning filters, projections and the filter funnel.

All are narrow transformations (no shuffle) except ``filter_funnel``, which
is one global aggregation with partial (map-side) counts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlens.schema import AUDIO_FEATURES, RELEASE_CUTOFF, TOP_CHART


def keep_chart(charts: DataFrame, chart: str = TOP_CHART) -> DataFrame:
    """Rows of one chart type (F1). Pushed down to the scan as an equality."""
    return charts.where(F.col("chart") == F.lit(chart))


def released_after(
    charts: DataFrame,
    day: str | dt.date = RELEASE_CUTOFF,
    inclusive: bool = False,
    release_col: str = "release_day",
) -> DataFrame:
    """Rows released after ``day`` (F2); rows without a release day drop out.

    The reference uses an exclusive cutoff for delay, streak, tier and model
    questions and an inclusive one for the title spread question.
    """
    cutoff = F.lit(dt.date.fromisoformat(day) if isinstance(day, str) else day)
    rel = F.col(release_col)
    return charts.where(rel >= cutoff if inclusive else rel > cutoff)


def min_feature(charts: DataFrame, feature: str, threshold: float) -> DataFrame:
    """Rows whose ``feature`` is at least ``threshold``."""
    return charts.where(F.col(feature) >= F.lit(threshold))


def valid_release(
    track_regions: DataFrame,
    release_col: str = "release_day",
    first_day_col: str = "first_chart_day",
) -> DataFrame:
    """Track-regions with a known release no later than the first chart day.

    The ``0000`` sentinel is already NULL in the typed release day, so the
    null test covers it.
    """
    rel = F.col(release_col)
    return track_regions.where(rel.isNotNull() & (rel <= F.col(first_day_col)))


def from_origin(edges: DataFrame, origins: str | Sequence[str], col: str = "from_region") -> DataFrame:
    """Edges that leave from one origin region, or from any of a list."""
    if isinstance(origins, str):
        return edges.where(F.col(col) == F.lit(origins))
    return edges.where(F.col(col).isin(list(origins)))


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL or NaN in any of ``cols``."""
    return df.dropna(subset=list(cols))


def typed_features(df: DataFrame, features: Sequence[str] = AUDIO_FEATURES) -> DataFrame:
    """Model input types (P1): ``explicit`` boolean, features double.

    ``try_cast`` so that a stray text value becomes NULL instead of failing
    the job under ANSI mode. The reference narrows to 32-bit floats; we keep
    doubles.
    """
    casts = {"explicit": F.col("explicit").try_cast("boolean")}
    casts.update({c: F.col(c).try_cast("double") for c in features})
    return df.withColumns(casts)


def filter_funnel(df: DataFrame, steps: Sequence[tuple[str, Column]], level: str = "rows") -> DataFrame:
    """Row counts after each cumulative filter step, in one job (S3).

    ``steps`` is a list of (name, condition); step i keeps rows meeting
    conditions 1..i. The first output row is the unfiltered count. One
    aggregation with partial counts per task replaces one ``count()`` job
    (and one full scan) per step. Output: (level, step_no, step, row_count).
    """
    aggs = [F.count(F.lit(1)).alias("c0")]
    cond = F.lit(True)
    for i, (_, c) in enumerate(steps, start=1):
        cond = cond & F.coalesce(c, F.lit(False))
        aggs.append(F.count_if(cond).alias(f"c{i}"))
    names = ["input", *[n for n, _ in steps]]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"{i}, '{n}', c{i}" for i, n in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {pairs}) as (step_no, step, row_count)").select(
        F.lit(level).alias("level"),
        F.col("step_no").cast("int").alias("step_no"),
        "step",
        F.col("row_count").cast("bigint").alias("row_count"),
    )

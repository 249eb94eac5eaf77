"""Track lifecycle per (track, region): debut, delay, streak, peak.

Scale notes
-----------
* Every per-(track, region) result is a ``groupBy`` with partial (map-side)
  aggregation, so a track-region holding a large share of all rows is
  combined inside each task before the shuffle.
* The streak is built from month blocks: one row per (track, region, month) with
  a bit per chart day and a count per stretch of days, combined map-side, so at most one
  row per track-region-month is moved, however many raw rows there are. Blocks add
  up: those of new shards merge with stored ones without a rescan.
* Medians come from counting histograms (``functions.histogram``): every
  aggregate has fixed-size buffers.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartlens.functions.histogram import histogram, stats_of
from chartlens.schema import STREAK_MAX_GAP_DAYS

KEY = ["track_id", "region"]


def _stats(df: DataFrame, by: str, value: str, suffix: str) -> DataFrame:
    """avg, exact median, min, max of ``value`` per ``by``, avg descending."""
    stats = stats_of(histogram(df, [by], value), [by], value, suffix)
    return stats.orderBy(F.col(f"avg_{suffix}").desc(), F.col(by))


def track_region(charts: DataFrame) -> DataFrame:
    """One row per (track, region) (L1, with L2's first chart day).

    Columns: track_id, region, release_day (min over the rows; the reference
    takes an arbitrary ``first``), first_chart_day, chart_entries (rows with
    a date).
    """
    return charts.groupBy(*KEY).agg(
        F.min("release_day").alias("release_day"),
        F.min("date").alias("first_chart_day"),
        F.count("date").alias("chart_entries"),
    )


def debut_day(track_regions: DataFrame) -> DataFrame:
    """First chart day per (track, region) (L2)."""
    return track_regions.select(*KEY, "first_chart_day")


def debut_delay(track_regions: DataFrame) -> DataFrame:
    """Days from release to first chart day (L3): ``days_until_chart``."""
    return track_regions.withColumn("days_until_chart", F.datediff("first_chart_day", "release_day"))


def delay_by_region(delays: DataFrame) -> DataFrame:
    """Delay statistics per region, highest average first (L4, Q1 report).

    Expects ``debut_delay`` rows already restricted by ``valid_release``.
    """
    return _stats(delays, "region", "days_until_chart", "days_until_chart")


def _stretch(max_gap: int) -> int:
    """Days in a stretch: any two of its days are at most ``max_gap`` apart, so a stretch never splits a run."""
    return min(max_gap + 1, 31)


def month_blocks(
    charts: DataFrame, max_gap: int = STREAK_MAX_GAP_DAYS, by: Sequence[str] = (), aggs: Sequence[Column] = ()
) -> DataFrame:
    """Chart days per (track, region, month): the streak's additive state.

    Columns: the key, ``by``, month (first day; NULL for rows without a date), m (bit d - 1
    set: there are rows on day d), n (rows), n0, n1, ... (rows per stretch of
    ``max_gap`` + 1 days of the month), and ``aggs``. Every buffer has a
    fixed size, so this is one hash aggregation with map-side combine.
    """
    width, day = _stretch(max_gap), F.dayofmonth("date")
    counts = [
        F.count_if((day > low) & (day <= low + width)).alias(f"n{i}") for i, low in enumerate(range(0, 31, width))
    ]
    bit = F.expr("shiftleft(1, dayofmonth(date) - 1)")
    return charts.groupBy(*KEY, *by, F.trunc("date", "month").alias("month")).agg(
        F.bit_or(bit).alias("m"), F.count("date").alias("n"), *counts, *aggs
    )


def merge_month_blocks(*blocks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Blocks of several sets of rows (``month_blocks`` without ``aggs``) as those of all rows."""
    every = reduce(DataFrame.unionByName, blocks)
    counts = [c for c in every.columns if c not in (*KEY, *by, "month", "m")]
    return every.groupBy(*KEY, *by, "month").agg(F.bit_or("m").alias("m"), *[F.sum(c).alias(c) for c in counts])


def block_pieces(blocks: DataFrame, max_gap: int = STREAK_MAX_GAP_DAYS, carry: Sequence[str] = ()) -> DataFrame:
    """Pieces of runs: the key, ``carry``, start, end and n (rows from start to end).

    A block whose days are one run (its mask has one day with no other on the
    ``max_gap`` days before it) gives one piece, another block one per stretch with rows. A
    block without dates gives a piece of NULL days and no rows.
    """
    width, m = _stretch(max_gap), F.col("m")
    starts = m
    for k in range(1, min(max_gap, 30) + 1):
        starts = starts.bitwiseAND(F.bitwise_not(F.shiftleft(m, k)))
    counts = F.array(*[c for c in blocks.columns if c[0] == "n" and c[1:].isdigit()])
    one = F.coalesce(F.bit_count(starts) <= 1, F.lit(True))
    rows = blocks.withColumn("_one", one)
    rows = rows.select("*", F.posexplode(F.when(F.col("_one"), F.array("n")).otherwise(counts)).alias("_at", "_n"))
    rows = rows.where(F.col("_one") | (F.col("_n") > 0))
    stretch = m.bitwiseAND(F.expr(f"shiftleft({(1 << width) - 1}, _at * {width})"))
    rows = rows.withColumn("_days", F.when(F.col("_one"), m).otherwise(stretch))
    days = F.col("_days")
    first, last = (F.length(F.bin(x)) - 1 for x in (days.bitwiseAND(-days), days))
    ends = [F.date_add("month", first).alias("start"), F.date_add("month", last).alias("end")]
    return rows.select(*KEY, *carry, *ends, F.col("_n").alias("n"))


def numbered_pieces(pieces: DataFrame, max_gap: int = STREAK_MAX_GAP_DAYS) -> DataFrame:
    """Pieces with ``run_id``: a run ends where the next piece starts more than ``max_gap`` days after all before it.

    The window of a track-region holds a few rows per month (``block_pieces``).
    """
    w = Window.partitionBy(*KEY).orderBy(F.col("start").asc_nulls_first())
    reached = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(reached.isNull() | (F.datediff("start", reached) > max_gap), 1).otherwise(0)
    rows = pieces.withColumn("_starts", starts)
    run = F.sum("_starts").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("run_id", run).drop("_starts")


def longest_streak(charts: DataFrame, max_gap: int = STREAK_MAX_GAP_DAYS) -> DataFrame:
    """Longest run of chart entries with gaps of at most ``max_gap`` days.

    Rule: sort a track-region's chart dates; a run continues while the next
    date is at most ``max_gap`` days after the previous one. The run length
    counts entries, so a repeated date lengthens it. A track-region with fewer than two dated
    entries has length 1.

    Plan: month blocks [partial aggregation] -> pieces of runs -> window per (track, region)
    joins pieces across month edges -> sum of rows per run -> max per (track,
    region). Output: track_id, region, days_in_chart (int).
    """
    return longest_streak_of_blocks(month_blocks(charts, max_gap), max_gap)


def longest_streak_of_blocks(blocks: DataFrame, max_gap: int = STREAK_MAX_GAP_DAYS) -> DataFrame:
    """``longest_streak`` from stored blocks (made with the same ``max_gap``)."""
    return (
        numbered_pieces(block_pieces(blocks, max_gap), max_gap)
        .groupBy(*KEY, "run_id")
        .agg(F.sum("n").alias("run_len"))
        .groupBy(*KEY)
        .agg(F.greatest(F.max("run_len"), F.lit(1)).cast("int").alias("days_in_chart"))
    )


def track_region_summary(charts: DataFrame, max_gap: int = STREAK_MAX_GAP_DAYS) -> DataFrame:
    """L1 and L5 in one pass: release day, first chart day, entries, streak.

    Same blocks and runs as ``longest_streak``; the release day rides along as a
    minimum, so one scan and two shuffles (blocks, then the track-region window) give everything the
    delay and streak reports need. Output: track_id, region, release_day,
    first_chart_day, chart_entries, days_in_chart.
    """
    blocks = month_blocks(charts, max_gap, aggs=[F.min("release_day").alias("release_day")])
    pieces = numbered_pieces(block_pieces(blocks, max_gap, ["release_day"]), max_gap)
    per_run = pieces.groupBy(*KEY, "run_id").agg(
        F.sum("n").alias("run_len"), F.min("start").alias("run_first"), F.min("release_day").alias("release_day")
    )
    return per_run.groupBy(*KEY).agg(*summary_columns())


def summary_columns() -> list[Column]:
    """Release day, first chart day, entries and streak of a track-region from its runs."""
    return [
        F.min("release_day").alias("release_day"),
        F.min("run_first").alias("first_chart_day"),
        F.sum("run_len").alias("chart_entries"),
        F.greatest(F.max("run_len"), F.lit(1)).cast("int").alias("days_in_chart"),
    ]


def streak_by_region(streaks: DataFrame) -> DataFrame:
    """Streak statistics per region, highest average first (L6, Q2 report)."""
    return _stats(streaks, "region", "days_in_chart", "days_in_chart")


def peak_rank(charts: DataFrame) -> DataFrame:
    """Best (lowest) rank per (track, region) (L7): ``highest_ranking``."""
    return charts.groupBy(*KEY).agg(F.min("rank").alias("highest_ranking"))

"""Artists of chart rows and artist popularity tiers (A1-A5).

The reference collects each tier's artist list on the driver and puts it
back into the plan as a literal array. Here tiers are a DataFrame joined
to a (track, region, artist) bridge, so nothing passes through the driver
and the tier lists can be any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlens.functions.ranking import split_points, with_global_position
from chartlens.schema import TIERS

KEY = ["track_id", "region"]


def explode_artists(charts: DataFrame, col: str = "artist", outer: bool = False) -> DataFrame:
    """One row per artist of a chart row (A1); with ``outer``, a NULL artist yields a row with a NULL one.

    The artist text is split on commas and each piece trimmed of spaces; a
    NULL artist yields no row, empty pieces stay as ``''``. Trimming the
    whole text and splitting on a comma with any spaces around it gives the
    same pieces as trimming each piece, without a per-element lambda (so
    the projection stays in generated code).
    """
    artists = F.split(F.trim(F.col(col)), " *, *")
    return charts.withColumn(col, F.explode_outer(artists) if outer else F.explode(artists))


def artist_bridge(exploded: DataFrame) -> DataFrame:
    """Distinct (track, region, artist) with the pair's first chart day (A2).

    Partial aggregation removes repeated rows inside each task before the
    shuffle, so a hot track or artist is reduced early.
    """
    return exploded.groupBy(*KEY, "artist").agg(F.min("date").alias("first_chart_day"))


def track_region_artists(exploded: DataFrame) -> DataFrame:
    """Per (track, region): release day, first chart day and sorted artist set (A2).

    The artist set is built from distinct artists only (bounded by the
    artists credited on one track), never from raw rows.
    """
    per_artist = exploded.groupBy(*KEY, "artist").agg(
        F.min("release_day").alias("release_day"), F.min("date").alias("first_chart_day")
    )
    return per_artist.groupBy(*KEY).agg(
        F.min("release_day").alias("release_day"),
        F.min("first_chart_day").alias("first_chart_day"),
        F.sort_array(F.collect_list("artist")).alias("artists"),
    )


def artist_counts(bridge: DataFrame) -> DataFrame:
    """Number of (track, region) pairs per artist (A3): ``n_track_regions``."""
    return bridge.groupBy("artist").agg(F.count(F.lit(1)).alias("n_track_regions"))


def artist_tiers(counts: DataFrame, partitions: int | None = None) -> DataFrame:
    """Split artists into thirds by popularity (A4).

    Artists are ordered by count descending, then name; with ``n`` artists
    and ``s = n div 3``, positions 1..s are ``top``, s+1..2s ``middle`` and
    the rest (including the remainder) ``bottom``. The position is computed
    with a range-partitioned global numbering, not a one-task window.
    Output: artist, n_track_regions, position, tier.
    """
    ranked = with_global_position(
        counts,
        [F.col("n_track_regions").desc(), F.col("artist").asc()],
        name="position",
        total_name="n_artists",
        partitions=partitions,
    )
    third = F.floor(F.col("n_artists") / 3)
    tier = (
        F.when(F.col("position") <= third, TIERS[0])
        .when(F.col("position") <= 2 * third, TIERS[1])
        .otherwise(TIERS[2])
    )
    return ranked.select("artist", "n_track_regions", "position", tier.alias("tier"))


def tiers_by_count(counts: DataFrame) -> DataFrame:
    """Artists and their tiers as ``artist_tiers`` gives them, without positions: artist, n_track_regions, tier.

    Only the last artist of ``top`` and of ``middle`` are looked for, by a histogram
    of the counts (``ranking.split_points``); every other artist is compared with these two. So no
    artist is sorted, written or joined, and the two names are all that reach the driver.
    """
    n, name = F.col("n_track_regions"), F.col("artist")
    last = split_points(counts, "n_track_regions", "artist", lambda total: [k * F.floor(total / 3) for k in (1, 2)])
    tier = F.lit(TIERS[2])
    for (most, final), label in reversed(list(zip(last, TIERS))):
        # NULL names stand first among equals
        upto = name.isNull() if final is None else F.coalesce(name <= F.lit(final), F.lit(True))
        tier = F.when((n > most) | ((n == most) & upto), label).otherwise(tier)
    return counts.select("artist", "n_track_regions", tier.alias("tier"))


def tier_tracks(bridge: DataFrame, tiers: DataFrame) -> DataFrame:
    """(track, region, tier) for every tier one of the pair's artists is in (A5).

    A track-region with artists in two tiers is in both. The join on artist
    is left to the planner: AQE broadcasts the tier table when it measures
    it small and splits a skewed artist's partition otherwise.
    """
    return bridge.join(tiers.select("artist", "tier"), "artist").select(*KEY, "tier").distinct()


def tier_flags(bridge: DataFrame, tiers: DataFrame, cluster_by: tuple[str, ...] = ("track_id",)) -> DataFrame:
    """Per (track, region): first chart day and one membership flag per tier.

    Same membership as ``tier_tracks`` but as one row per track-region
    (``in_top``, ``in_middle``, ``in_bottom``), so that later steps keep a
    single row per pair and need no join back.

    The joined rows are clustered by ``cluster_by`` (track) before the
    aggregation, so the per-track origin window that follows reuses that
    partitioning instead of shuffling again. The bridge is already
    aggregated: a track has one row per (region, artist), whatever the
    number of raw chart rows.
    """
    return _flags(bridge.join(tiers.select("artist", "tier"), "artist"), F.col("first_chart_day"), cluster_by)


def all_tier_flags(bridge: DataFrame, tiers: DataFrame, cluster_by: tuple[str, ...] = ("track_id",)) -> DataFrame:
    """``tier_flags`` of a bridge with NULL artists: a track-region without artists has a row, without day and flags.

    Rows with a NULL artist go round the join, so they do not meet in one task.
    """
    known = bridge.where(F.col("artist").isNotNull()).join(tiers.select("artist", "tier"), "artist")
    unknown = bridge.where(F.col("artist").isNull()).withColumn("tier", F.lit(None).cast("string"))
    day = F.when(F.col("tier").isNotNull(), F.col("first_chart_day"))
    return _flags(known.unionByName(unknown), day, cluster_by)


def _flags(joined: DataFrame, day: Column, cluster_by: tuple[str, ...]) -> DataFrame:
    if cluster_by:
        joined = joined.repartition(*cluster_by)
    return joined.groupBy(*KEY).agg(
        F.min(day).alias("first_chart_day"),
        *[F.max(F.col("tier") == t).alias(f"in_{t}") for t in TIERS],
    )

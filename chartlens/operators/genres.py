"""Rule-based genres: profiles, leaders, counts, adoption and shares.

The reference runs these in pandas on one machine. Here every step is a
Spark aggregation with partial (map-side) combine; windows only appear
over per-(region, genre) aggregates (at most six rows per region).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartlens.functions.dates import month_of
from chartlens.functions.genre import genre_of
from chartlens.schema import GENRES, QUARTILES

#: log2 of the registers of a distinct sketch
SKETCH_LG_K = 12


def with_genre(charts: DataFrame) -> DataFrame:
    """Add ``genre`` from danceability, energy and key (G1)."""
    return charts.withColumn("genre", genre_of())


def with_month(charts: DataFrame, date_col: str = "date") -> DataFrame:
    """Add ``month`` (first day of the month of ``date_col``)."""
    return charts.withColumn("month", month_of(date_col))


def genre_month_stats(rows: DataFrame) -> DataFrame:
    """Rows, mean danceability and mean energy per (region, month, genre) (G3 + G6).

    One aggregation that every monthly and regional genre result can be
    derived from; Catalyst drops whichever aggregates a caller does not use.
    """
    return rows.groupBy("region", "month", "genre").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.avg("af_danceability").alias("avg_danceability"),
        F.avg("af_energy").alias("avg_energy"),
    )


def genre_profile(rows: DataFrame) -> DataFrame:
    """Mean danceability and energy per (region, month, genre)."""
    return genre_month_stats(rows).select("region", "month", "genre", "avg_danceability", "avg_energy")


def best_genre(profile: DataFrame) -> DataFrame:
    """Per (region, month), the genre with the highest mean danceability.

    Ties on danceability go to the higher mean energy, then to the genre
    name; missing means rank last. Picked with ``min_by`` over an ordering
    struct, which aggregates partially like ``min``.
    """
    d, e = F.col("avg_danceability"), F.col("avg_energy")
    order = F.struct(d.isNull(), -d, e.isNull(), -e, F.col("genre"))
    best = F.min_by(F.struct("genre", "avg_danceability", "avg_energy"), order)
    return profile.groupBy("region", "month").agg(best.alias("b")).select(
        "region", "month", "b.genre", "b.avg_danceability", "b.avg_energy"
    )


def region_count(df: DataFrame) -> DataFrame:
    """Number of distinct regions (G5): one row, ``n_regions``."""
    return df.agg(F.count_distinct("region").alias("n_regions"))


def distinct_sketches(rows: DataFrame, by: Sequence[str], column: str = "region", lg_k: int = SKETCH_LG_K) -> DataFrame:
    """A HyperLogLog sketch of the distinct values of ``column`` per group (G5, mergeable form): ``by``, ``sketch``.

    A sketch has at most about ``2 ** lg_k`` bytes, whatever it has seen, and sketches
    of shards, months or regions merge (``sketched_count``): written per month, they
    count any span of months without the rows, and a new month only adds its
    own. NULLs are not counted.
    """
    return rows.groupBy(*by).agg(F.hll_sketch_agg(column, lg_k).alias("sketch"))


def sketched_count(sketches: DataFrame, by: Sequence[str] = (), name: str = "n_regions") -> DataFrame:
    """Estimated distinct values per group of merged ``distinct_sketches``.

    Relative standard error about ``sketch_error(lg_k)``; sets that are small against the
    sketch are counted exactly. Without sketches and groups: one row, 0.
    """
    merged = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy(*by).agg(F.coalesce(merged, F.lit(0)).cast("bigint").alias(name))


def sketch_error(lg_k: int = SKETCH_LG_K) -> float:
    """Relative standard error of ``sketched_count``."""
    return 1.04 / 2 ** (lg_k / 2)


def genre_counts(rows: DataFrame) -> DataFrame:
    """Chart rows per (region, month, genre) (G6): ``record_count``."""
    return genre_month_stats(rows).select("region", "month", "genre", "record_count")


def _rows_in(df: DataFrame):
    """Row count of a group: counts genre rows, or sums ``record_count``
    when given per (region, month, genre) counts."""
    return F.sum("record_count") if "record_count" in df.columns else F.count(F.lit(1))


def genre_pivot(df: DataFrame) -> DataFrame:
    """Per (region, month), one count column per genre, 0 if none.

    Takes genre rows or ``genre_counts`` / ``genre_month_stats``. The genre
    list is fixed, so ``pivot`` needs no extra job to find the values.
    """
    return (
        df.groupBy("region", "month")
        .pivot("genre", GENRES)
        .agg(_rows_in(df))
        .na.fill(0, subset=GENRES)
    )


def genre_adoption(rows: DataFrame) -> DataFrame:
    """First month of each genre in each region (G8): ``first_appearance``.

    Works on genre rows or on ``genre_counts`` (same months appear in both).
    """
    return rows.groupBy("genre", "region").agg(F.min("month").alias("first_appearance"))


def genre_spread(adoption: DataFrame) -> DataFrame:
    """Per genre: earliest and latest regional adoption, months between."""
    return (
        adoption.groupBy("genre")
        .agg(
            F.min("first_appearance").alias("earliest_adoption"),
            F.max("first_appearance").alias("latest_adoption"),
        )
        .withColumn(
            "duration_months",
            F.months_between("latest_adoption", "earliest_adoption").cast("int"),
        )
    )


def genre_share(df: DataFrame) -> DataFrame:
    """Rows per (region, genre) and their percent of the region's rows.

    Takes genre rows, or ``genre_counts`` / ``genre_month_stats`` (months
    are then summed).
    """
    per_genre = df.groupBy("region", "genre").agg(_rows_in(df).cast("bigint").alias("genre_count"))
    total = F.sum("genre_count").over(Window.partitionBy("region"))
    return per_genre.withColumn("percentage", F.col("genre_count") / total * 100)


def share_quartile(shares: DataFrame) -> DataFrame:
    """Quartile (Q1..Q4) of each genre's share inside its region.

    Edges are the 25/50/75 % quantiles of the region's genre counts with
    linear interpolation; bins are right-closed and the lowest value is
    included (the count orders genres exactly as the percentage does,
    without rounding at the edges). When edges coincide, a value takes
    the lowest quartile it fits.
    """
    edges = F.percentile("genre_count", [0.25, 0.5, 0.75]).over(Window.partitionBy("region"))
    c = F.col("genre_count")
    q = (
        F.when(c <= F.col("_e")[0], QUARTILES[0])
        .when(c <= F.col("_e")[1], QUARTILES[1])
        .when(c <= F.col("_e")[2], QUARTILES[2])
        .otherwise(QUARTILES[3])
    )
    return shares.withColumn("_e", edges).withColumn("quartile", q).drop("_e")


def top_genre_per_quartile(quartiles: DataFrame) -> DataFrame:
    """Per (region, quartile), the genre with the largest share.

    Ties go to the first genre by name.
    """
    order = F.struct(-F.col("genre_count"), F.col("genre"))
    return quartiles.groupBy("region", "quartile").agg(F.min_by("genre", order).alias("genre"))

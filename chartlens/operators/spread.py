"""Spread of tracks and titles from their first region to others (M1-M8).

Two meanings, kept apart as in the reference:

* first arrivals (tier question): per track, the region(s) where it charted
  first worldwide are its origins; every other region it reaches gives one
  edge origin -> region, dated by that region's first chart day.
* chart-day spread (title question): per title, every chart row in another
  region on or after the title's first day is an edge from every origin
  row, so averages weigh regions by how long the title stays there.

Scale notes: all windows are partitioned by track or title and run on
per-(key, region) aggregates, so a window group holds at most one row per
region, whatever the number of raw rows. No edge list is built where only
its sums are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartlens.functions.histogram import histogram, stats_of
from chartlens.schema import TIERS

#: Rows of one side of a title's edges in a join cell (``title_edges``); a cell has about this squared edges.
EDGE_SIDE = 1024


def origins(track_regions: DataFrame, key: str = "track_id", day: str = "first_chart_day") -> DataFrame:
    """Region(s) where each key first charted (M1); ties give several rows.

    A day in an unknown (NULL) region counts as a key's first day, but names
    no origin.

    A window minimum per key replaces the reference's self-join to its own
    aggregate (one shuffle instead of two). Output: key, first_date,
    first_region.
    """
    w = Window.partitionBy(key)
    valid = track_regions.where(F.col(key).isNotNull() & F.col(day).isNotNull())
    return (
        valid.withColumn("first_date", F.min(day).over(w))
        .where((F.col(day) == F.col("first_date")) & F.col("region").isNotNull())
        .select(key, "first_date", F.col("region").alias("first_region"))
    )


def first_arrivals(track_regions: DataFrame, key: str = "track_id", day: str = "first_chart_day") -> DataFrame:
    """One edge per (key, region) reached after the key's origin (M3).

    For a region ``r`` the edge comes from the alphabetically first origin
    other than ``r`` (the reference keeps an arbitrary one); a region that
    is the only origin gets no edge. A key that first charted in an unknown
    (NULL) region only has no origin and so no edge. Computed in one window pass per key:
    first day, smallest origin and second smallest origin; no join between
    origins and regions. Extra columns of ``track_regions`` (tier flags)
    are carried along.
    Output: key, from_region, to_region, from_date, to_date, plus extras.
    """
    extras = [c for c in track_regions.columns if c not in (key, "region", day)]
    w = Window.partitionBy(key)
    valid = track_regions.where(F.col(key).isNotNull() & F.col(day).isNotNull())
    s1 = valid.withColumn("from_date", F.min(day).over(w))
    is_origin = F.col(day) == F.col("from_date")
    s2 = s1.withColumn("_o1", F.min(F.when(is_origin, F.col("region"))).over(w))
    s3 = s2.withColumn("_o2", F.min(F.when(is_origin & (F.col("region") != F.col("_o1")), F.col("region"))).over(w))
    src = F.when(F.col("region") == F.col("_o1"), F.col("_o2")).otherwise(F.col("_o1"))
    return (
        s3.withColumn("from_region", src)
        .where(F.col("from_region").isNotNull() & F.col("region").isNotNull())
        .select(
            key,
            "from_region",
            F.col("region").alias("to_region"),
            "from_date",
            F.col(day).alias("to_date"),
            *extras,
        )
    )


def days_to_popular(edges: DataFrame) -> DataFrame:
    """Days between leaving the origin and arriving (M5): ``days_to_popular``."""
    return edges.withColumn("days_to_popular", F.datediff("to_date", "from_date"))


def explode_tiers(edges: DataFrame) -> DataFrame:
    """One edge row per tier the destination track-region belongs to."""
    tiers = F.array(*[F.when(F.col(f"in_{t}"), F.lit(t)) for t in TIERS])
    flags = [f"in_{t}" for t in TIERS]
    return edges.withColumn("tier", F.explode(tiers)).where(F.col("tier").isNotNull()).drop(*flags)


def spread_by_destination(edges: DataFrame, group: Sequence[str] = ("tier",)) -> DataFrame:
    """avg, exact median, min, max of days per destination (M6).

    Column names follow the reference report (``*_days_until_chart``);
    ordered by group, then average descending.
    """
    return spread_of(edge_histogram(edges, group), group)


def edge_histogram(edges: DataFrame, group: Sequence[str] = ("tier",)) -> DataFrame:
    """Edges per (group, from, to, days): ``n``. One aggregation of the edges that M6 and M7 both follow from.

    Its size is bounded by the corridors and the calendar, not by the edges.
    """
    return histogram(edges, [*group, "from_region", "to_region"], "days_to_popular")


def spread_of(hist: DataFrame, group: Sequence[str] = ("tier",)) -> DataFrame:
    """``spread_by_destination`` from ``edge_histogram``."""
    stats = stats_of(hist, [*group, "to_region"], "days_to_popular", "days_until_chart")
    return stats.orderBy(*group, F.col("avg_days_until_chart").desc(), "to_region")


def corridors_of(hist: DataFrame, group: Sequence[str] = ("tier",)) -> DataFrame:
    """``corridor_avg`` from ``edge_histogram``."""
    days = F.sum(F.col("days_to_popular") * F.col("n"))
    known = F.sum(F.when(F.col("days_to_popular").isNotNull(), F.col("n")))
    return (
        hist.groupBy(*group, "from_region", "to_region")
        .agg(F.try_divide(days, known).alias("avg_days_to_popular"))
        .orderBy(*group, "from_region", "avg_days_to_popular", "to_region")
    )


def corridor_avg(edges: DataFrame, group: Sequence[str] = ("tier",)) -> DataFrame:
    """Mean days from each origin to each destination (M7), ascending.

    One aggregation for every origin at once; restrict origins with
    ``clean.from_origin`` before or after.
    """
    return (
        edges.groupBy(*group, "from_region", "to_region")
        .agg(F.avg("days_to_popular").alias("avg_days_to_popular"))
        .orderBy(*group, "from_region", "avg_days_to_popular", "to_region")
    )


def title_days(rows: DataFrame, key: str = "title") -> DataFrame:
    """Chart rows per (title, region, date): ``n``. Rows without a title or a date are left out."""
    known = rows.where(F.col(key).isNotNull() & F.col("date").isNotNull())
    return known.groupBy(key, "region", "date").agg(F.count(F.lit(1)).alias("n"))


def title_region_days(rows: DataFrame, key: str = "title") -> DataFrame:
    """Per (title, region): rows, day sums and rows on the title's first day (M2 input).

    Partial aggregations per day and per region, then one window per title
    over at most one row per region. Columns: key, region, n_rows,
    first_date (the title's), origin_rows (rows of this region on the
    title's first day; > 0 marks an origin), sum_days (sum over this
    region's rows of days since the title's first day).
    """
    return region_days_of(title_days(rows, key), key)


def region_days_of(per_day: DataFrame, key: str = "title") -> DataFrame:
    """``title_region_days`` from ``title_days``."""
    # Reduce to one row per (title, region) before anything is keyed by
    # title alone: a hot title then reaches the per-title window as at most
    # one row per region.
    per_region = per_day.groupBy(key, "region").agg(
        F.min("date").alias("region_first"),
        F.min_by("n", "date").alias("n_on_region_first"),
        F.sum("n").alias("n_rows"),
        F.sum(F.col("n") * F.unix_date("date")).alias("_day_sum"),
    )
    w = Window.partitionBy(key)
    with_first = per_region.withColumn("first_date", F.min("region_first").over(w))
    return with_first.select(
        key,
        "region",
        "n_rows",
        "first_date",
        F.when(F.col("region_first") == F.col("first_date"), F.col("n_on_region_first"))
        .otherwise(F.lit(0))
        .cast("bigint")
        .alias("origin_rows"),
        (F.col("_day_sum") - F.col("n_rows") * F.unix_date("first_date")).alias("sum_days"),
    )


def title_origins(region_days: DataFrame, key: str = "title") -> DataFrame:
    """Origins of each title (M2): key, first_date, first_region, origin_rows.

    The reference keeps one origin row per raw row on the first day;
    ``origin_rows`` carries that multiplicity as a count.
    """
    return region_days.where(F.col("origin_rows") > 0).select(
        key, "first_date", F.col("region").alias("first_region"), "origin_rows"
    )


def chart_day_spread(region_days: DataFrame, key: str = "title") -> DataFrame:
    """Chart-day edges from origins to other regions, summed per corridor (M4).

    An origin row of region X and a chart row of region Y != X of the same
    title form one edge; its days are the row's day minus the title's first
    day. Per title and corridor the edge count is ``origin_rows(X) *
    n_rows(Y)`` and the day total ``origin_rows(X) * sum_days(Y)``.

    Plan: a window per title (same partitioning as ``title_region_days``,
    so no new shuffle) gives every region row the title's origin list -
    at most one entry per origin region - which is exploded into
    (from, to) corridor rows and summed per corridor with partial
    aggregation. A title with ``k`` origin regions charting in ``r``
    regions yields ``k * r`` corridor rows: one per region in the usual
    single-origin case, never more than regions squared (the corridor
    domain itself), independent of how many chart rows the title has. The
    reference's row form pairs every origin row with every later chart
    row instead. No self-join.
    Output: from_region, to_region, edges, total_days, avg_days_to_popular.
    """
    origin = F.when(
        F.col("origin_rows") > 0,
        F.struct(F.col("region").alias("from_region"), F.col("origin_rows").alias("o_rows")),
    )
    with_origins = region_days.withColumn("_origins", F.collect_list(origin).over(Window.partitionBy(key)))
    pairs = (
        with_origins.select(
            F.col("region").alias("to_region"), "n_rows", "sum_days", F.explode("_origins").alias("o")
        )
        .select("o.from_region", "to_region", "o.o_rows", "n_rows", "sum_days")
        .where(F.col("from_region") != F.col("to_region"))
    )
    return pairs.groupBy("from_region", "to_region").agg(
        F.sum(F.col("o_rows") * F.col("n_rows")).alias("edges"),
        F.sum(F.col("o_rows") * F.col("sum_days")).alias("total_days"),
    ).withColumn("avg_days_to_popular", F.col("total_days") / F.col("edges"))


def title_edges(days: DataFrame, key: str = "title", side: int = EDGE_SIDE) -> DataFrame:
    """Chart-day edges one by one (M4): key, from_region, to_region, from_date, to_date.

    ``days`` is ``title_days``, best written once: it is read three times. Every
    origin row of a title (a row on its first day) meets each of its chart rows
    in another region, so a row that the chart repeats repeats its edges.
    ``days_to_popular`` (M5) applies to the result.

    A title's edges are its origin rows times its chart rows, so both sides
    of the join are dealt by their measured sizes. Equal rows travel as one counted
    row, cut into pieces of at most ``side`` rows; a title's pieces go to
    ``ceil(rows / side)`` parts of each side, and each pair of parts is a cell of
    about ``side`` squared edges with a join key of its own. A piece is copied once
    per part of the other side: once, for a title with up to ``side`` origin rows.
    Counts become rows after the join only, inside a cell. The counted rows are small
    whatever the edges, so by their bytes the planner would put all cells into a task or
    two, or broadcast the chart rows and make all edges where the origin rows are. So the chart rows
    are dealt by cell into ``spark.sql.shuffle.partitions`` tasks and meet the origin rows there by a
    merge join, whichever side is smaller. Regions that are NULL neither send nor receive an edge.
    """
    spark = days.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    regions = region_days_of(days, key)
    starts = title_origins(regions, key).where(F.col("first_region").isNotNull())
    sizes = regions.groupBy(key).agg(
        F.min("first_date").alias("from_date"), F.sum("n_rows").alias("_to"), F.sum("origin_rows").alias("_from")
    )
    sizes = sizes.select(
        key, "from_date", F.ceil(F.col("_from") / side).alias("_o_parts"), F.ceil(F.col("_to") / side).alias("_d_parts")
    )

    def pieces(side_rows: DataFrame, count: str, parts: str, place: Sequence[str]) -> DataFrame:
        numbered = side_rows.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(count) - 1) / side))))
        held = F.least(F.lit(side).cast("bigint"), F.col(count) - F.col("_piece") * side)
        return numbered.withColumn("_held", held).withColumn("_part", F.pmod(F.xxhash64(*place, "_piece"), F.col(parts)))

    def copies(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(parts) - 1))

    o = pieces(starts.join(sizes, key), "origin_rows", "_o_parts", ["first_region"])
    o = o.select(key, F.col("first_region").alias("from_region"), F.col("_held").alias("_o"), F.col("_part").alias("_o_part"), copies("_d_parts").alias("_d_part"))
    d = pieces(days.where(F.col("region").isNotNull()).join(sizes, key), "n", "_d_parts", ["region", "date"])
    d = d.select(
        key, F.col("region").alias("to_region"), "from_date", F.col("date").alias("to_date"), F.col("_held").alias("_d"),
        F.col("_part").alias("_d_part"), copies("_o_parts").alias("_o_part"),
    )
    cell = [key, "_o_part", "_d_part"]
    met = d.repartition(tasks, *cell).join(o.hint("merge"), cell).where(F.col("from_region") != F.col("to_region"))
    each = F.explode(F.array_repeat(F.lit(0), (F.col("_o") * F.col("_d")).cast("int")))
    return met.select(key, "from_region", "to_region", "from_date", "to_date", each.alias("_row")).drop("_row")


def corridor_avg_rounded(spread: DataFrame) -> DataFrame:
    """Mean days per corridor rounded half-up to whole days (M8), ascending."""
    return spread.select(
        "from_region", "to_region", F.round("avg_days_to_popular", 0).alias("avg_days_to_popular")
    ).orderBy("from_region", "avg_days_to_popular", "to_region")

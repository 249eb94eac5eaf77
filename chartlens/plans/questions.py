"""The reference's questions as composed plans over a typed chart frame.

Each function takes the typed chart DataFrame (``sources.typed_charts`` or
``sources.read_chart_table``). Most only build lazy plans; the exceptions
run jobs on purpose: ``tier_inputs`` writes the tier bridge and looks up where the
tiers end, ``lifecycle_summary`` writes the track-regions, ``assembled_data`` checkpoints the model rows, and ``q5_forest`` /
``q5_linear`` fit models. Written tables stay until the application's folder
is removed, or the end of a ``session.scratch`` block. The ``..._question``
functions also give the funnel of their question, counted by the same jobs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlens.operators import artists, clean, genres, lifecycle, model, spread
from chartlens.operators.counters import SideCounter, counted
from chartlens.schema import DANCEABLE_MIN, MODEL_FEATURES, RELEASE_CUTOFF, TIERS
from chartlens.session import fresh_path, shared_dir
from chartlens.sources.charts import CORRUPT


def lifecycle_base(charts: DataFrame) -> DataFrame:
    """top200 rows released strictly after the cutoff (input of Q1, Q2, Q5)."""
    return clean.released_after(clean.keep_chart(charts))


def q1_delay(charts: DataFrame) -> DataFrame:
    """Q1: days from release to first chart day, per region."""
    tr = lifecycle.track_region(lifecycle_base(charts))
    return lifecycle.delay_by_region(clean.valid_release(lifecycle.debut_delay(tr)))


def q2_streak(charts: DataFrame) -> DataFrame:
    """Q2: longest near-consecutive chart run, per region (no release check)."""
    return lifecycle.streak_by_region(lifecycle.longest_streak(lifecycle_base(charts)))


def row_steps(charts: DataFrame) -> list:
    """Cleaning steps of chart rows. Charts from files (``read_charts``) first leave out their malformed rows."""
    cutoff = F.lit(RELEASE_CUTOFF).cast("date")
    well_formed = [("well formed", F.col(CORRUPT).isNull())] if CORRUPT in charts.columns else []
    return [
        *well_formed,
        ("chart is top200", F.col("chart") == "top200"),
        ("released after 2017-01-01", F.col("release_day") > cutoff),
    ]


TRACK_REGION_STEPS = [
    ("release known", lambda: F.col("release_day").isNotNull()),
    ("release on or before first chart day", lambda: F.col("release_day") <= F.col("first_chart_day")),
]


def lifecycle_summary(charts: DataFrame, features: bool = False) -> tuple[DataFrame, DataFrame]:
    """(summary, funnel): one row per track-region, written once, and the counts of the rows on the way.

    The only scan of the chart rows for the delay and streak questions, and
    with ``features`` for the model question too (``model.lifecycle_frame``). The funnel
    is counted by the same job (``counters.SideCounter``); that is why this scan reads every chart
    and release: the rows left out are counted too.
    """
    names = ["track_id", "region", "date", "release_day", "chart", *([CORRUPT] if CORRUPT in charts.columns else [])]
    if features:
        names += ["rank", *MODEL_FEATURES]
    rows = SideCounter(charts.select(*names), row_steps(charts))
    base = lifecycle_base(rows.rows)
    per_track = model.lifecycle_frame(base) if features else lifecycle.track_region_summary(base)
    track_regions = SideCounter(per_track, [(n, c()) for n, c in TRACK_REGION_STEPS], level="track_regions")
    summary = materialize(track_regions.rows, "track-region-summary")
    return summary, rows.funnel().unionByName(track_regions.funnel())


def q1_q2(charts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q1 and Q2 reports from one scan: (delay report, streak report)."""
    return delay_and_streak_of(lifecycle_summary(charts)[0])


def delay_and_streak_of(summary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q1 and Q2 reports from a ``lifecycle_summary``."""
    delay = lifecycle.delay_by_region(clean.valid_release(lifecycle.debut_delay(summary)))
    return delay, lifecycle.streak_by_region(summary)


def funnel(charts: DataFrame) -> DataFrame:
    """Rows left after each cleaning step, at row and track-region level, counted by the job that makes the summary."""
    return lifecycle_summary(charts)[1]


# ---------------------------------------------------------------- Q4 tiers
def tier_question(charts: DataFrame) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """(edges, funnel) of the tier question from one scan of the chart rows.

    The counts ride on the jobs that write the bridge and read the edges (``counters.SideCounter``); call
    ``funnel`` after a job has read all edges. Track-regions without artists
    are kept up to the flags, to be counted there.
    """
    base = lifecycle_base(charts).select("track_id", "region", "date", "release_day", "artist")
    rows = SideCounter(base, input="released after 2017-01-01")
    pairs = artists.artist_bridge(artists.explode_artists(rows.rows, outer=True))
    pairs = SideCounter(pairs, [("track-regions with artists, one per artist", F.col("artist").isNotNull())])
    bridge = materialize(pairs.rows, "tier-bridge")
    tiers = artists.tiers_by_count(artists.artist_counts(bridge.where(F.col("artist").isNotNull())))
    flags = artists.all_tier_flags(bridge, tiers)
    flags = SideCounter(flags, also={t: F.col(f"in_{t}") for t in TIERS})
    edges = _edges(flags.rows.where(F.col("first_chart_day").isNotNull()))

    def funnel() -> DataFrame:
        per_tier = {r["tier"]: r["count"] for r in tiers.groupBy("tier").count().collect()}  # three rows
        found = [("all", 0, "released after 2017-01-01", rows.counts()[0])]
        found.append(("all", 1, "track-regions", flags.counts()[0]))
        found.append(("all", 2, "track-regions with artists, one per artist", pairs.counts()[1]))
        found.append(("all", 3, "artists", sum(per_tier.values())))
        found += [(t, 4, "artists", n) for t, n in per_tier.items()]
        found += [(t, 5, "track-regions", flags.other(t)) for t in per_tier]
        return counted(charts.sparkSession, found)

    return edges, funnel


def tier_funnel(charts: DataFrame) -> DataFrame:
    """Sizes along the tier question: rows, track-regions, artist rows, artists and track-regions per tier.

    Output: (level, step_no, step, row_count), counted by the jobs that make the tier histogram.
    """
    edges, counts = tier_question(charts)
    materialize(spread.edge_histogram(edges), "tier-histogram")
    return counts()


def artist_rows(charts: DataFrame) -> DataFrame:
    """Cleaned top200 rows, one per artist (input of Q4)."""
    base = lifecycle_base(charts).select("track_id", "region", "date", "release_day", "artist")
    return artists.explode_artists(base)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as a parquet table in the shared folder and read it back.

    Used where one intermediate feeds several branches that Spark cannot
    share (differently pruned copies of one aggregate are planned, and
    scanned, separately). The plan runs once; the written table also cuts
    the lineage, so a lost executor costs a re-read, not a re-run of the
    upstream plan.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def tier_inputs(charts: DataFrame):
    """(bridge, tiers) of the tier question.

    The bridge (distinct track, region, artist) is read twice: for the
    artist counts (by each round of ``tiers_by_count``) and for the join back to tiers. It is written
    once (``materialize``) so the chart rows are scanned and exploded once.
    """
    bridge = materialize(artists.artist_bridge(artist_rows(charts)), "tier-bridge")
    tiers = artists.tiers_by_count(artists.artist_counts(bridge))
    return bridge, tiers


def track_regions_with_artists(charts: DataFrame) -> DataFrame:
    """(track, region, first_chart_day) of pairs with at least one artist."""
    bridge = artists.artist_bridge(artist_rows(charts))
    return bridge.groupBy("track_id", "region").agg(F.min("first_chart_day").alias("first_chart_day"))


def tier_edges(charts: DataFrame) -> DataFrame:
    """Q4 edges: (tier, track, from_region, to_region, from_date, to_date, days)."""
    return _edges(artists.tier_flags(*tier_inputs(charts)))


def _edges(flags: DataFrame) -> DataFrame:
    edges = spread.days_to_popular(spread.first_arrivals(flags))
    return spread.explode_tiers(edges).select(
        "tier", "track_id", "from_region", "to_region", "from_date", "to_date", "days_to_popular"
    )


def q4_spread(charts: DataFrame) -> DataFrame:
    """Q4 report: days to reach each region, per artist tier."""
    return spread.spread_by_destination(tier_edges(charts))


def q4_corridors(charts: DataFrame, origins=None) -> DataFrame:
    """Q4 corridor reports: mean days from each origin (or the listed ones), per tier.

    The reference reports France, Japan and the United Kingdom
    (``TIER_ORIGINS``); one aggregation serves every origin.
    """
    edges = tier_edges(charts)
    return spread.corridor_avg(edges if origins is None else clean.from_origin(edges, origins))


# ---------------------------------------------------------------- Q3 titles
def title_rows(charts: DataFrame) -> DataFrame:
    """Rows of the title question: released on/after the cutoff, danceable, top200."""
    rows = clean.released_after(charts, RELEASE_CUTOFF, inclusive=True)
    rows = clean.keep_chart(clean.min_feature(rows, "af_danceability", DANCEABLE_MIN))
    return rows.select("title", "date", "region")


def title_spread(charts: DataFrame) -> DataFrame:
    """Q3 corridor sums over all origins."""
    return spread.chart_day_spread(spread.title_region_days(title_rows(charts)))


def title_edges(charts: DataFrame) -> DataFrame:
    """Q3 edges one by one with their days: (title, from_region, to_region, from_date, to_date, days_to_popular).

    The rows per title, region and day are written once; sizes, origins and chart days are read from them.
    """
    days = materialize(spread.title_days(title_rows(charts)), "title-days")
    return spread.days_to_popular(spread.title_edges(days))


def q3_corridors(charts: DataFrame, origins=None) -> DataFrame:
    """Q3 reports: rounded mean days from each origin (or the listed ones).

    The reference reports five origins (``TITLE_ORIGINS``).
    """
    s = title_spread(charts)
    return spread.corridor_avg_rounded(s if origins is None else clean.from_origin(s, origins))


# ---------------------------------------------------------------- Q6 genres
def genre_rows(charts: DataFrame, date_col: str = "date") -> DataFrame:
    """All chart rows (any chart, any release) with genre and month (Q6 input)."""
    rows = charts.select("region", date_col, "af_danceability", "af_energy", "af_key")
    return genres.with_month(genres.with_genre(rows), date_col)


def annotated_rows(charts: DataFrame, date_col: str = "date") -> DataFrame:
    """Every chart row with its genre and month: the row-level genre dataset."""
    return genres.with_month(genres.with_genre(charts.drop(CORRUPT)), date_col)


def q6_best_genre(charts: DataFrame, date_col: str = "date") -> DataFrame:
    """Q6: leading genre per region and month."""
    return genres.best_genre(genres.genre_profile(genre_rows(charts, date_col)))


def month_sketches(charts: DataFrame, column: str, by=(), date_col: str = "date") -> DataFrame:
    """Sketches of the distinct values of a column per month (and ``by``), written once, to be merged over any span."""
    rows = genres.with_month(charts.select(column, date_col, *by), date_col)
    return materialize(genres.distinct_sketches(rows, ["month", *by], column), f"{column}-sketches")


def q6_quartiles(charts: DataFrame, date_col: str = "date") -> DataFrame:
    """Q6: genre share quartiles per region."""
    return genres.share_quartile(genres.genre_share(genre_rows(charts, date_col)))


# ---------------------------------------------------------------- Q5 model
def model_data(charts: DataFrame) -> DataFrame:
    """Complete model rows with label and train/test split (Q5 input)."""
    frame = model.model_frame(lifecycle_base(charts))
    return model.train_test_split(model.complete_rows(frame))


# Partitions that models are trained in. A fitted forest depends on it (rows are
# sampled per partition), so it is fixed, not derived from the data or the
# cluster; raise it for much larger catalogues.
MODEL_PARTITIONS = 16


def model_question(charts: DataFrame, lifecycle_: tuple[DataFrame, DataFrame] | None = None):
    """(data, funnel) of the model question: ``assembled_data`` and the rows left on the way, counted by the same jobs.

    ``lifecycle_`` is a ``lifecycle_summary`` with features to reuse.
    """
    summary, rows = lifecycle_ or lifecycle_summary(charts, features=True)
    whole = F.lit(True)
    for c in [*MODEL_FEATURES, model.LABEL_SOURCE]:
        whole = whole & F.col(c).isNotNull()
    frame = SideCounter(
        model.train_test_split(model.frame_of(summary)),
        [("features and peak rank known", whole), ("train", F.col("split") == "train")],
        level="track_regions",
    )
    data = fixed_layout(model.complete_rows(frame.rows))
    return data, rows.where(F.col("level") == "rows").unionByName(frame.funnel())


def assembled_data(charts: DataFrame, partitions: int = MODEL_PARTITIONS) -> DataFrame:
    """Model rows with the feature vector, in a fixed layout, lineage cut (``fixed_layout``)."""
    return fixed_layout(model_data(charts), partitions)


def fixed_layout(rows: DataFrame, partitions: int = MODEL_PARTITIONS) -> DataFrame:
    """Model rows with the feature vector, dealt and sorted once and checkpointed in the shared folder.

    Every pass of a fit, and any task retried after a lost executor, reads the
    checkpointed partitions. The forest samples rows per partition from its seed, so the rows
    are hash-partitioned by (track, region) into ``partitions`` partitions and
    sorted inside each: with the same ``partitions``, the seed fixes every
    tree's sample whatever the size of the data, the cluster or its settings.
    """
    shared_dir(rows.sparkSession)
    dealt = rows.repartition(partitions, "track_id", "region").sortWithinPartitions("track_id", "region")
    return model.assemble(dealt.checkpoint())


def model_funnel(charts: DataFrame) -> DataFrame:
    """Rows left along the model question: chart rows, then model rows, then the two splits."""
    return model_question(charts)[1]


def split_of(data: DataFrame, which: str) -> DataFrame:
    return data.where(F.col("split") == which)


def q5_forest(charts: DataFrame, data: DataFrame | None = None):
    """Q5 forest: (model, test predictions). ``data``: ``assembled_data`` to reuse."""
    data = assembled_data(charts) if data is None else data
    m = model.fit_forest(split_of(data, "train"))
    return m, m.transform(split_of(data, "test"))


def q5_linear(charts: DataFrame, data: DataFrame | None = None):
    """Q5 linear model: (model, test predictions). ``data``: ``assembled_data`` to reuse."""
    data = assembled_data(charts) if data is None else data
    m = model.fit_linear(split_of(data, "train"))
    return m, m.transform(split_of(data, "test"))

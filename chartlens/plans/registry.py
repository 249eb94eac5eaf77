"""Registered queries: name -> (spark, sf_dir) -> DataFrame, with oracle SQL.

Every query reads the test tables of ``sf_dir`` through the chart rule and
runs the library's operators on all of the rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartlens.operators import artists, clean, forest, genres, lifecycle, linear, model, spread
from chartlens.plans import oracle as O
from chartlens.plans import questions as Q
from chartlens.plans.reports import TIER_ORIGIN_NAMES, TITLE_ORIGIN_NAMES
from chartlens.schema import (
    AUDIO_FEATURES,
    CHART_COLUMNS,
    DANCEABLE_MIN,
    GENRES,
    MODEL_FEATURES,
    RELEASE_CUTOFF,
    TIER_ORIGINS,
    TITLE_ORIGINS,
)
from chartlens.session import fresh_path
from chartlens.sources import chart_rows, growing_chart_rows, read_charts, read_report, typed_charts, write_report

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str, oracle: str | None = None):
    """Register a query builder and (optionally) its oracle SQL."""

    def wrap(fn: Callable[[DataFrame], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(charts_of(spark, sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            O.register(name, oracle)
        return fn

    return wrap


def growing_query(name: str, oracle: str):
    """The same over the growing fixture, whose keys grow with the tables."""

    def wrap(fn: Callable[[DataFrame], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(typed_charts(growing_chart_rows(spark, sf_dir)))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        O.register(name, O.growing(oracle))
        return fn

    return wrap


def charts_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed chart rows for a test-data folder."""
    return typed_charts(chart_rows(spark, sf_dir))


# ---------------------------------------------------------------- sources
@query(
    "chart_typed",
    O.sql(f"select {O.CHART_COLS}, long_date, release_day from chart"),
)
def _chart_typed(c: DataFrame) -> DataFrame:
    """All chart rows with the typed release day."""
    return c.select(*CHART_COLUMNS, "long_date", "release_day")


# ---------------------------------------------------------------- lifecycle
@query(
    "track_region",
    O.sql("select track_id, region, release_day, first_chart_day, chart_entries from tr"),
)
def _track_region(c: DataFrame) -> DataFrame:
    """One row per (track, region) of the cleaned top200 rows."""
    return lifecycle.track_region(Q.lifecycle_base(c))


@query(
    "delay_by_region",
    O.sql(
        O.stats_sql("d", "region", "days_until_chart", "days_until_chart"),
        d="""select region, cast(first_chart_day - release_day as int) as days_until_chart from tr
             where release_day is not null and release_day <= first_chart_day""",
    ),
)
def _delay_by_region(c: DataFrame) -> DataFrame:
    """Q1 report: release-to-chart delay statistics per region."""
    return Q.q1_delay(c)


TYPED = CHART_COLUMNS + ["release_day"]
TYPED_SQL = O.CHART_COLS + ", release_day"


def rows_sql(where: str) -> str:
    return O.sql(f"select {TYPED_SQL} from chart where {where}")


# ---------------------------------------------------------------- filters
@query("keep_chart", rows_sql("chart = 'top200'"))
def _keep_chart(c: DataFrame) -> DataFrame:
    """Rows of the top200 chart (F1)."""
    return clean.keep_chart(c).select(*TYPED)


@query("released_after", rows_sql("chart = 'top200' and release_day > date '2017-01-01'"))
def _released_after(c: DataFrame) -> DataFrame:
    """top200 rows released strictly after 2017-01-01 (F1 + F2 exclusive)."""
    return Q.lifecycle_base(c).select(*TYPED)


@query("released_on_or_after", rows_sql("release_day >= date '2017-01-01'"))
def _released_on_or_after(c: DataFrame) -> DataFrame:
    """Rows released on or after 2017-01-01 (F2 inclusive, title spread)."""
    return clean.released_after(c, RELEASE_CUTOFF, inclusive=True).select(*TYPED)


@query("min_feature", rows_sql("af_danceability >= 0.75"))
def _min_feature(c: DataFrame) -> DataFrame:
    """Rows with danceability at least 0.75."""
    return clean.min_feature(c, "af_danceability", DANCEABLE_MIN).select(*TYPED)


@query(
    "valid_release",
    O.sql(
        """select track_id, region, release_day, first_chart_day, chart_entries from tr
           where release_day is not null and release_day <= first_chart_day"""
    ),
)
def _valid_release(c: DataFrame) -> DataFrame:
    """Track-regions with a release day no later than the first chart day."""
    return clean.valid_release(lifecycle.track_region(Q.lifecycle_base(c)))


@query(
    "typed_features",
    O.sql(
        "select track_id, region, date, explicit, "
        + ", ".join(f"cast({f} as double) as {f}" for f in AUDIO_FEATURES)
        + " from top"
    ),
)
def _typed_features(c: DataFrame) -> DataFrame:
    """Model input types on the cleaned top200 rows."""
    return clean.typed_features(Q.lifecycle_base(c)).select("track_id", "region", "date", "explicit", *AUDIO_FEATURES)


# ---------------------------------------------------------------- funnel
FUNNEL_SQL = O.sql(
    """select 'rows' as level, 0 as step_no, 'input' as step, count(*) as row_count from chart
       union all select 'rows', 1, 'chart is top200', count(*) from chart where chart = 'top200'
       union all select 'rows', 2, 'released after 2017-01-01', count(*) from top
       union all select 'track_regions', 0, 'input', count(*) from tr
       union all select 'track_regions', 1, 'release known', count(*) from tr where release_day is not null
       union all select 'track_regions', 2, 'release on or before first chart day', count(*) from tr
                 where release_day is not null and release_day <= first_chart_day"""
)


@query("filter_funnel", FUNNEL_SQL)
def _filter_funnel(c: DataFrame) -> DataFrame:
    """Row counts after each cleaning step (S3): two single-pass aggregations."""
    return Q.funnel(c)


# ---------------------------------------------------------------- lifecycle
@query("debut_day", O.sql("select track_id, region, first_chart_day from tr"))
def _debut_day(c: DataFrame) -> DataFrame:
    """First chart day per (track, region) (L2)."""
    return lifecycle.debut_day(lifecycle.track_region(Q.lifecycle_base(c)))


@query(
    "debut_delay",
    O.sql(
        """select track_id, region, release_day, first_chart_day, chart_entries,
                  cast(first_chart_day - release_day as int) as days_until_chart from tr"""
    ),
)
def _debut_delay(c: DataFrame) -> DataFrame:
    """Days from release to first chart day per (track, region) (L3)."""
    return lifecycle.debut_delay(lifecycle.track_region(Q.lifecycle_base(c)))


STREAK_CTES = dict(
    s1="""select track_id, region, date,
                 lag(date) over (partition by track_id, region order by date) as prev from top""",
    s2="""select *, sum(case when prev is null or date - prev > 3 then 1 else 0 end)
                 over (partition by track_id, region order by date
                       rows between unbounded preceding and current row) as run_id from s1""",
    s3="select track_id, region, run_id, count(date) as run_len from s2 group by track_id, region, run_id",
    streak="""select track_id, region, cast(greatest(max(run_len), 1) as int) as days_in_chart
              from s3 group by track_id, region""",
)


@query("longest_streak", O.sql("select * from streak", **STREAK_CTES))
def _longest_streak(c: DataFrame) -> DataFrame:
    """Longest run of chart entries at most 3 days apart, per (track, region)."""
    return lifecycle.longest_streak(Q.lifecycle_base(c))


@query("streak_by_region", O.sql(O.stats_sql("streak", "region", "days_in_chart", "days_in_chart"), **STREAK_CTES))
def _streak_by_region(c: DataFrame) -> DataFrame:
    """Q2 report: streak statistics per region."""
    return Q.q2_streak(c)


@query("peak_rank", O.sql("select track_id, region, min(rank) as highest_ranking from top group by track_id, region"))
def _peak_rank(c: DataFrame) -> DataFrame:
    """Best rank per (track, region)."""
    return lifecycle.peak_rank(Q.lifecycle_base(c))


# ---------------------------------------------------------------- sinks
def _report_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the Q1 report as CSV under the shared folder and read it back."""
    report = Q.q1_delay(charts_of(spark, sf_dir))
    path = fresh_path(spark, "report-q1")
    write_report(report, path)
    return read_report(spark, path, report.schema)


QUERIES["report_round_trip"] = _report_round_trip
O.register("report_round_trip", O.ORACLE["delay_by_region"])


# ---------------------------------------------------------------- artists (Q4)
def _in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


ARTIST_CTES = dict(
    ex="""select track_id, region, date, release_day, trim(unnest(string_split(artist, ','))) as artist
          from top where artist is not null""",
    bridge="""select track_id, region, artist, min(date) as first_chart_day
              from ex group by track_id, region, artist""",
    tra="select track_id, region, min(date) as first_chart_day from ex group by track_id, region",
    counts="select artist, count(*) as n_track_regions from bridge group by artist",
    ranked="""select artist, n_track_regions,
                     row_number() over (order by n_track_regions desc, artist) as position,
                     count(*) over () as n_artists
              from counts""",
    tiers="""select artist, n_track_regions, position,
                    case when position <= n_artists // 3 then 'top'
                         when position <= 2 * (n_artists // 3) then 'middle'
                         else 'bottom' end as tier
             from ranked""",
    tier_tr="select distinct b.track_id, b.region, t.tier from bridge b join tiers t on b.artist = t.artist",
    origins="""select o.track_id, o.first_chart_day as first_date, o.region as first_region
               from tra o join (select track_id, min(first_chart_day) as m from tra group by track_id) g
                 on o.track_id = g.track_id and o.first_chart_day = g.m""",
    raw_edges="""select t.tier, o.track_id, o.first_region as from_region, b.region as to_region,
                        o.first_date as from_date, b.first_chart_day as to_date
                 from origins o
                 join tra b on o.track_id = b.track_id and b.first_chart_day >= o.first_date
                              and o.first_region <> b.region
                 join tier_tr t on t.track_id = b.track_id and t.region = b.region""",
    arrivals="""select tier, track_id, min(from_region) as from_region, to_region,
                       min(from_date) as from_date, min(to_date) as to_date
                from raw_edges group by tier, track_id, to_region""",
    days="select *, cast(to_date - from_date as int) as days_to_popular from arrivals",
)


@query("explode_artists", O.sql("select track_id, region, date, artist from ex", **ARTIST_CTES))
def _explode_artists(c: DataFrame) -> DataFrame:
    """One row per artist of each cleaned top200 row (A1)."""
    return Q.artist_rows(c).select("track_id", "region", "date", "artist")


@query(
    "track_region_artists",
    O.sql(
        """select track_id, region, min(release_day) as release_day, min(date) as first_chart_day,
                  list_sort(list(distinct artist)) as artists
           from ex group by track_id, region""",
        **ARTIST_CTES,
    ),
)
def _track_region_artists(c: DataFrame) -> DataFrame:
    """Per (track, region): release, first chart day, sorted artist set (A2)."""
    return artists.track_region_artists(Q.artist_rows(c))


@query("artist_counts", O.sql("select * from counts", **ARTIST_CTES))
def _artist_counts(c: DataFrame) -> DataFrame:
    """Track-region pairs per artist (A3)."""
    return artists.artist_counts(artists.artist_bridge(Q.artist_rows(c)))


@query("artist_tiers", O.sql("select * from tiers", **ARTIST_CTES))
def _artist_tiers(c: DataFrame) -> DataFrame:
    """Artist popularity thirds: top, middle, bottom with the remainder (A4)."""
    return artists.artist_tiers(artists.artist_counts(artists.artist_bridge(Q.artist_rows(c))))


@query("tiers_by_count", O.sql("select artist, n_track_regions, tier from tiers", **ARTIST_CTES))
def _tiers_by_count(c: DataFrame) -> DataFrame:
    """The same thirds from a histogram of the counts, without positions (A4)."""
    return Q.tier_inputs(c)[1]


@query("tier_tracks", O.sql("select * from tier_tr", **ARTIST_CTES))
def _tier_tracks(c: DataFrame) -> DataFrame:
    """Track-regions of each tier's artists (A5)."""
    bridge, tiers = Q.tier_inputs(c)
    return artists.tier_tracks(bridge, tiers)


# ---------------------------------------------------------------- spread (Q4)
@query("track_origins", O.sql("select * from origins", **ARTIST_CTES))
def _track_origins(c: DataFrame) -> DataFrame:
    """Region(s) where each track first charted (M1)."""
    return spread.origins(Q.track_regions_with_artists(c))


@query(
    "first_arrivals",
    O.sql("select tier, track_id, from_region, to_region, from_date, to_date from arrivals", **ARTIST_CTES),
)
def _first_arrivals(c: DataFrame) -> DataFrame:
    """One edge per tier, track and region reached after the origin (M3)."""
    return Q.tier_edges(c).drop("days_to_popular")


@query("days_to_popular", O.sql("select * from days", **ARTIST_CTES))
def _days_to_popular(c: DataFrame) -> DataFrame:
    """First-arrival edges with days from origin to region (M5)."""
    return Q.tier_edges(c)


@query(
    "spread_by_destination",
    O.sql(
        """select tier, to_region, avg(days_to_popular) as avg_days_until_chart,
                  median(days_to_popular) as median_days_until_chart,
                  min(days_to_popular) as min_days_until_chart, max(days_to_popular) as max_days_until_chart
           from days group by tier, to_region order by tier, avg_days_until_chart desc, to_region""",
        **ARTIST_CTES,
    ),
)
def _spread_by_destination(c: DataFrame) -> DataFrame:
    """Q4 report: days-to-region statistics per tier and destination (M6)."""
    return Q.q4_spread(c)


FROM_ORIGIN_SQL = O.sql(f"select * from days where from_region in ({_in_list(TIER_ORIGINS)})", **ARTIST_CTES)


@growing_query("from_origin", FROM_ORIGIN_SQL)
def _from_origin(c: DataFrame) -> DataFrame:
    """Q4 edges leaving France, Japan or the United Kingdom (F5), on the growing fixture."""
    return clean.from_origin(Q.tier_edges(c), TIER_ORIGINS)


@query(
    "corridor_avg",
    O.sql(
        """select tier, from_region, to_region, avg(days_to_popular) as avg_days_to_popular
            from days group by tier, from_region, to_region
            order by tier, from_region, avg_days_to_popular, to_region""",
        **ARTIST_CTES,
    ),
)
def _corridor_avg(c: DataFrame) -> DataFrame:
    """Q4 corridors: mean days from every origin to every region, per tier (M7)."""
    return Q.q4_corridors(c)


# ---------------------------------------------------------------- titles (Q3)
TITLE_CTES = dict(
    q3="""select title, date, region from chart
          where release_day >= date '2017-01-01' and af_danceability >= 0.75 and chart = 'top200'""",
    t_first="select title, min(date) as first_date from q3 group by title",
    t_orig="""select a.title, a.first_date, o.region as first_region
              from t_first a join q3 o on a.title = o.title and a.first_date = o.date""",
    t_edges="""select a.title, a.first_region as from_region, b.region as to_region,
                      a.first_date as from_date, b.date as to_date,
                      cast(b.date - a.first_date as int) as days_to_popular
               from t_orig a join q3 b on a.title = b.title and b.date >= a.first_date
                                      and a.first_region <> b.region""",
)


@query(
    "title_origins",
    O.sql(
        """select title, first_date, first_region, count(*) as origin_rows
           from t_orig group by title, first_date, first_region""",
        **TITLE_CTES,
    ),
)
def _title_origins(c: DataFrame) -> DataFrame:
    """Region(s) where each danceable title first charted, with row multiplicity (M2)."""
    return spread.title_origins(spread.title_region_days(Q.title_rows(c)))


@query(
    "chart_day_spread",
    O.sql(
        """select from_region, to_region, count(*) as edges,
                  cast(sum(days_to_popular) as bigint) as total_days,
                  avg(days_to_popular) as avg_days_to_popular
           from t_edges group by from_region, to_region""",
        **TITLE_CTES,
    ),
)
def _chart_day_spread(c: DataFrame) -> DataFrame:
    """Title chart-day edges summed per corridor, all origins (M4)."""
    return Q.title_spread(c)


@query(
    "title_edges",
    O.sql(
        """select title, from_region, to_region, from_date, to_date, days_to_popular
           from t_edges""",
        **TITLE_CTES,
    ),
)
def _title_edges(c: DataFrame) -> DataFrame:
    """Title chart-day edges row by row with their days (M4 + M5)."""
    return Q.title_edges(c)


@query(
    "corridor_avg_rounded",
    O.sql(
        """select from_region, to_region, round(avg(days_to_popular), 0) as avg_days_to_popular
            from t_edges group by from_region, to_region order by from_region, avg_days_to_popular, to_region""",
        **TITLE_CTES,
    ),
)
def _corridor_avg_rounded(c: DataFrame) -> DataFrame:
    """Q3 corridors: rounded mean days from every origin to every region (M8)."""
    return Q.q3_corridors(c)


# ---------------------------------------------------------------- genres (Q6)
# The chart rule folds ``date`` into 90 days; ``long_date`` spans years and
# feeds the monthly genre questions (FIXTURES.md section 2).
GENRE_DATE = "long_date"

GENRE_CTES = dict(
    g0="""select region, long_date, af_danceability, af_energy, af_key,
                case when isnan(af_danceability) then null else af_danceability end as d,
                case when isnan(af_energy) then null else af_energy end as e,
                case when isnan(af_key) then null else af_key end as k
         from chart""",
    g="""select region, long_date, af_danceability, af_energy, af_key,
               case when d > 0.7 and e > 0.7 then 'Electronic'
                    when d > 0.6 and e <= 0.7 then 'Pop'
                    when d <= 0.6 and e > 0.6 then 'Rock'
                    when k in (1, 2, 3) and d < 0.5 then 'Classical'
                    when k in (8, 9, 10) and d > 0.5 then 'Hip-Hop'
                    else 'Other' end as genre,
               cast(date_trunc('month', long_date) as date) as month
        from g0""",
    profile="""select region, month, genre, avg(af_danceability) as avg_danceability,
                      avg(af_energy) as avg_energy
               from g group by region, month, genre""",
    best="""select region, month, genre, avg_danceability, avg_energy from (
              select *, row_number() over (partition by region, month
                        order by avg_danceability desc nulls last, avg_energy desc nulls last, genre) as rn
              from profile) where rn = 1""",
    adoption="select genre, region, min(month) as first_appearance from g group by genre, region",
    shares="""select region, genre, count(*) as genre_count,
                     count(*) / sum(count(*)) over (partition by region) * 100 as percentage
              from g group by region, genre""",
    edges="""select region, quantile_cont(genre_count, 0.25) as e1, quantile_cont(genre_count, 0.5) as e2,
                    quantile_cont(genre_count, 0.75) as e3
             from shares group by region""",
    quart="""select s.*, case when genre_count <= e1 then 'Q1' when genre_count <= e2 then 'Q2'
                              when genre_count <= e3 then 'Q3' else 'Q4' end as quartile
             from shares s join edges using (region)""",
)


def genre_rows_of(c: DataFrame) -> DataFrame:
    return Q.genre_rows(c, GENRE_DATE)


@query(
    "with_genre",
    O.sql("select region, long_date, af_danceability, af_energy, af_key, genre from g", **GENRE_CTES),
)
def _with_genre(c: DataFrame) -> DataFrame:
    """Every chart row with its rule-based genre (G1)."""
    rows = c.select("region", GENRE_DATE, "af_danceability", "af_energy", "af_key")
    return genres.with_genre(rows)


@query("with_month", O.sql("select region, long_date, month from g", **GENRE_CTES))
def _with_month(c: DataFrame) -> DataFrame:
    """Every chart row with the month of its chart day."""
    return genres.with_month(c.select("region", GENRE_DATE), GENRE_DATE)


@query("genre_profile", O.sql("select * from profile", **GENRE_CTES))
def _genre_profile(c: DataFrame) -> DataFrame:
    """Mean danceability and energy per region, month and genre."""
    return genres.genre_profile(genre_rows_of(c))


@query("best_genre", O.sql("select * from best", **GENRE_CTES))
def _best_genre(c: DataFrame) -> DataFrame:
    """Leading genre per region and month."""
    return Q.q6_best_genre(c, GENRE_DATE)


@query("region_count", O.sql("select count(distinct region) as n_regions from best", **GENRE_CTES))
def _region_count(c: DataFrame) -> DataFrame:
    """Distinct regions in the leading-genre table."""
    return genres.region_count(Q.q6_best_genre(c, GENRE_DATE))


@query(
    "region_count_sketched",
    O.sql(
        """select 'exact' as method, count(distinct region) as n_regions from chart
           union all select 'sketch', count(distinct region) from chart"""
    ),
)
def _region_count_sketched(c: DataFrame) -> DataFrame:
    """Distinct regions, exact and from merged monthly sketches (G5); so few are counted exactly by both."""
    sketched = genres.sketched_count(Q.month_sketches(c, "region", date_col=GENRE_DATE))
    both = genres.region_count(c).withColumn("method", F.lit("exact"))
    return both.unionByName(sketched.withColumn("method", F.lit("sketch"))).select("method", "n_regions")


@query(
    "genre_counts",
    O.sql("select region, month, genre, count(*) as record_count from g group by region, month, genre", **GENRE_CTES),
)
def _genre_counts(c: DataFrame) -> DataFrame:
    """Chart rows per region, month and genre."""
    return genres.genre_counts(genre_rows_of(c))


@query(
    "genre_pivot",
    O.sql(
        "select region, month, "
        + ", ".join(f"""count(*) filter (where genre = '{g}') as "{g}\"""" for g in GENRES)
        + " from g group by region, month",
        **GENRE_CTES,
    ),
)
def _genre_pivot(c: DataFrame) -> DataFrame:
    """Genre counts as one column per genre, per region and month."""
    return genres.genre_pivot(genres.genre_counts(genre_rows_of(c)))


@query("genre_adoption", O.sql("select * from adoption", **GENRE_CTES))
def _genre_adoption(c: DataFrame) -> DataFrame:
    """First month of each genre per region."""
    return genres.genre_adoption(genre_rows_of(c))


@query(
    "genre_spread",
    O.sql(
        """select genre, min(first_appearance) as earliest_adoption, max(first_appearance) as latest_adoption,
                  cast(datediff('month', min(first_appearance), max(first_appearance)) as int) as duration_months
           from adoption group by genre""",
        **GENRE_CTES,
    ),
)
def _genre_spread(c: DataFrame) -> DataFrame:
    """Per genre: first and last regional adoption and months between."""
    return genres.genre_spread(genres.genre_adoption(genre_rows_of(c)))


@query("genre_share", O.sql("select * from shares", **GENRE_CTES))
def _genre_share(c: DataFrame) -> DataFrame:
    """Rows and percent of the region per genre."""
    return genres.genre_share(genre_rows_of(c))


@query("share_quartile", O.sql("select region, genre, genre_count, percentage, quartile from quart", **GENRE_CTES))
def _share_quartile(c: DataFrame) -> DataFrame:
    """Quartile of each genre's share in its region."""
    return Q.q6_quartiles(c, GENRE_DATE)


@query(
    "top_genre_per_quartile",
    O.sql(
        """select region, quartile, genre from (
             select *, row_number() over (partition by region, quartile order by genre_count desc, genre) as rn
             from quart) where rn = 1""",
        **GENRE_CTES,
    ),
)
def _top_genre_per_quartile(c: DataFrame) -> DataFrame:
    """Genre with the largest share per region and quartile."""
    return genres.top_genre_per_quartile(Q.q6_quartiles(c, GENRE_DATE))


# ---------------------------------------------------------------- model (Q5)
FIRST_ROW_SQL = ", ".join(f"{c} nulls last" for c in ["date", "rank", "explicit", *AUDIO_FEATURES])
COMPLETE_SQL = " and ".join(
    [f"{c} is not null" for c in ["explicit", "highest_ranking"]]
    + [f"{c} is not null and not isnan({c})" for c in AUDIO_FEATURES]
)
MODEL_CTES = dict(
    **STREAK_CTES,
    feats=f"""select track_id, region, explicit, {", ".join(AUDIO_FEATURES)} from top
              qualify row_number() over (partition by track_id, region order by {FIRST_ROW_SQL}) = 1""",
    peak="select track_id, region, min(rank) as highest_ranking from top group by track_id, region",
    frame="""select p.track_id, p.region, p.highest_ranking, s.days_in_chart, f.* exclude (track_id, region)
             from peak p join streak s using (track_id, region) join feats f using (track_id, region)""",
    complete=f"select *, cast(highest_ranking as double) as label from frame where {COMPLETE_SQL}",
    splitted="""select *, case when cast('0x' || substr(md5(track_id || '|' || region), 1, 8) as bigint) % 100 < 80
                              then 'train' else 'test' end as split
                from complete""",
)


@query("audio_features", O.sql("select * from feats", **MODEL_CTES))
def _audio_features(c: DataFrame) -> DataFrame:
    """Explicit flag and audio features per (track, region)."""
    return model.audio_features(Q.lifecycle_base(c))


@query("model_frame", O.sql("select * from frame", **MODEL_CTES))
def _model_frame(c: DataFrame) -> DataFrame:
    """Peak rank, streak and features per (track, region) (R2)."""
    return model.model_frame(Q.lifecycle_base(c))


@query("drop_incomplete", O.sql("select * exclude (label) from complete", **MODEL_CTES))
def _drop_incomplete(c: DataFrame) -> DataFrame:
    """Model frame rows with every feature and the label present."""
    frame = model.model_frame(Q.lifecycle_base(c))
    return clean.drop_incomplete(frame, ["explicit", *AUDIO_FEATURES, "highest_ranking"])


@query("train_test_split", O.sql("select * from splitted", **MODEL_CTES))
def _train_test_split(c: DataFrame) -> DataFrame:
    """Complete model rows with label and hash-based train/test split."""
    return Q.model_data(c)


@query(
    "assembled",
    O.sql(
        "select track_id, region, label, split, "
        + ", ".join(f"cast({c} as double) as v{i}" for i, c in enumerate(["explicit", *AUDIO_FEATURES]))
        + " from splitted",
        **MODEL_CTES,
    ),
)
def _assembled(c: DataFrame) -> DataFrame:
    """Complete model rows with the 13-feature vector, as 13 doubles."""
    rows = model.assemble(Q.model_data(c)).withColumn("v", vector_to_array("features"))
    return rows.select("track_id", "region", "label", "split", *[F.col("v")[i].alias(f"v{i}") for i in range(13)])


@query("forest_predictions")
def _forest_predictions(c: DataFrame) -> DataFrame:
    """Random forest (50 trees, depth 10) predictions on the test split."""
    return Q.q5_forest(c)[1].select("track_id", "region", "label", "prediction")


# Least squares in SQL: sums of products about the means, Gauss-Jordan elimination, Student's t from its finite series.
DIGITS = 6
_K = len(MODEL_FEATURES)
_TRAIN_X = ", ".join(f"cast({c} as double) as x{i}" for i, c in enumerate([*MODEL_FEATURES, "label"]))


def _least_squares_ctes() -> dict[str, str]:
    k, every = _K, range(_K + 1)
    ctes = dict(
        xy=f"select {_TRAIN_X} from splitted where split = 'train'",
        centred="select " + ", ".join(f"avg(x{i}) as m{i}, stddev_pop(x{i}) as s{i}" for i in every) + ", count(*) as n from xy",
        z="select " + ", ".join(f"(x{i} - m{i}) / s{i} as z{i}" for i in every) + " from xy, centred",
        products="select " + ", ".join(f"sum(z{i} * z{j}) as p{i}_{j}" for i in every for j in every if i <= j) + " from z",
        cells=" union all ".join(
            f"select {i} as i, {j} as j, p{min(i, j)}_{max(i, j)} as v from products" for i in range(k) for j in every
        ),
        units="select c.i, c.j + 1 + u.j as j, case when c.i = u.j then 1e0 else 0e0 end as v "
        f"from cells c, (select unnest(range({k})) as j) u where c.j = {k}",
        g0="select * from cells union all select * from units",
    )
    for p in range(k):
        ctes[f"g{p + 1}"] = f"""select a.i, a.j, case when a.i = {p} then a.v / d.v else a.v - f.v * r.v / d.v end as v
            from g{p} a join (select j, v from g{p} where i = {p}) r on a.j = r.j
                 join (select i, v from g{p} where j = {p}) f on a.i = f.i, (select v from g{p} where i = {p} and j = {p}) d"""
    ctes["slopes"] = f"""select b.i, b.v * s.s / x.s as b, u.v / (x.s * x.s) as own, x.m, b.v as z
        from g{k} b join g{k} u on u.i = b.i and u.j = {k} + 1 + b.i
             join ({" union all ".join(f"select {i} as i, m{i} as m, s{i} as s from centred" for i in range(k))}) x on x.i = b.i,
             (select s{k} as s from centred) s
        where b.j = {k}"""
    ctes["residual"] = f"""select c.n, c.n - {k} - 1 as freedom,
        (select p{k}_{k} from products) * c.s{k} * c.s{k}
          - (select sum(s.z * c2.v) from slopes s join cells c2 on c2.i = s.i and c2.j = {k}) * c.s{k} * c.s{k} as sse
        from centred c"""
    ctes["inverse"] = f"""select u.i, u.j - {k} - 1 as j, u.v / (a.s * b.s) as v
        from g{k} u join ({" union all ".join(f"select {i} as i, s{i} as s from centred" for i in range(k))}) a on a.i = u.i
             join ({" union all ".join(f"select {i} as i, s{i} as s from centred" for i in range(k))}) b on b.i = u.j - {k} - 1
        where u.j > {k}"""
    ctes["coefs"] = f"""select i, b, own as spread from slopes
        union all
        select {k}, c.m{k} - (select sum(b * m) from slopes),
               1e0 / c.n + (select sum(v.v * a.m * b.m) from inverse v join slopes a on a.i = v.i join slopes b on b.i = v.j)
        from centred c"""
    ctes["tested"] = """select c.i, c.b, sqrt(r.sse / r.freedom * c.spread) as se,
        c.b / sqrt(r.sse / r.freedom * c.spread) as t, r.freedom as f, atan(abs(c.b / sqrt(r.sse / r.freedom * c.spread)) / sqrt(r.freedom)) as o
        from coefs c, residual r"""
    ctes["series"] = """select t.i, sum(case when t.f % 2 = 0
          then exp(lgamma(j.j + 0.5) - lgamma(j.j + 1) - lgamma(0.5) + 2 * j.j * ln(cos(t.o)))
          else exp(lgamma(j.j + 1) - lgamma(j.j + 1.5) + lgamma(1.5) + 2 * j.j * ln(cos(t.o))) end) as s
        from tested t join (select unnest(range((select freedom // 2 from residual))) as j) j
             on j.j <= case when t.f % 2 = 0 then (t.f - 2) // 2 else (t.f - 3) // 2 end
        group by t.i"""
    ctes["fitted"] = """select t.i, t.b, t.se, t.t, greatest(0, 1 - case when t.f % 2 = 0 then sin(t.o) * s.s
          else 2 / pi() * (t.o + sin(t.o) * cos(t.o) * s.s) end) as p
        from tested t join series s on s.i = t.i"""
    return ctes


LINEAR_CTES = dict(**MODEL_CTES, **_least_squares_ctes())
COEFFICIENTS_SQL = O.sql(
    f"""select v."index", v.feature, round(f.b, {DIGITS}) as coefficient, round(f.se, {DIGITS}) as std_error,
               round(f.t, {DIGITS}) as t_value, round(f.p, {DIGITS}) as p_value
        from fitted f join (values {", ".join(f"({i}, '{c}')" for i, c in enumerate([*MODEL_FEATURES, "intercept"]))}) v("index", feature)
             on v."index" = f.i""",
    **LINEAR_CTES,
)
PREDICTED_CTES = dict(
    **LINEAR_CTES,
    predicted="select track_id, region, label, (select b from fitted where i = "
    + f"{_K}) + "
    + " + ".join(f"cast({c} as double) * (select b from fitted where i = {i})" for i, c in enumerate(MODEL_FEATURES))
    + " as prediction from splitted where split = 'test'",
)


@query("linear_predictions", O.sql(f"select track_id, region, label, round(prediction, {DIGITS}) as prediction from predicted", **PREDICTED_CTES))
def _linear_predictions(c: DataFrame) -> DataFrame:
    """Linear regression predictions on the test split (R6), to six places."""
    rows = Q.q5_linear(c)[1]
    return rows.select("track_id", "region", "label", F.round("prediction", DIGITS).alias("prediction"))


def _train_sums(c: DataFrame):
    train = Q.split_of(Q.model_data(c), "train").select("track_id", *MODEL_FEATURES, "label")
    frame = linear.frame_of(train)
    return train, frame


@query(
    "linear_sums",
    O.sql(
        " union all ".join(
            f"select {i} as i, {j} as j, round(p{i}_{j}, {DIGITS}) as value from products" for i in range(_K + 1) for j in range(i, _K + 1)
        ),
        **LINEAR_CTES,
    ),
)
def _linear_sums(c: DataFrame) -> DataFrame:
    """X'X, X'y and y'y of the standardized training rows, merged from two disjoint halves."""
    train, frame = _train_sums(c)
    half = F.pmod(F.xxhash64("track_id"), F.lit(2)) == 0
    merged = linear.merge_sums(linear.sums(train.where(half), frame), linear.sums(train.where(~half), frame))
    return merged.where(f"j <= {_K}").select("i", "j", F.round("value", DIGITS).alias("value"))


@query("coefficients_from_sums", COEFFICIENTS_SQL)
def _coefficients_from_sums(c: DataFrame) -> DataFrame:
    """Coefficients, standard errors, t and p values from the mergeable sums (R9), to six places."""
    train, frame = _train_sums(c)
    return linear.solve(linear.sums(train, frame), frame).table(c.sparkSession, DIGITS)


@query(
    "forest_walk",
    O.sql("select track_id, region, label, true as same from splitted where split = 'test'", **MODEL_CTES),
)
def _forest_walk(c: DataFrame) -> DataFrame:
    """Test rows scored by joins with the forest's node table, against the model's own predictions."""
    fitted, predicted = Q.q5_forest(c)
    nodes = forest.forest_nodes(fitted)
    scored = forest.score(predicted, nodes, ["track_id", "region"]).withColumnRenamed("prediction", "walked")
    same = F.abs(F.col("walked") - F.col("prediction")) <= 1e-9
    rows = predicted.join(scored, ["track_id", "region"], "left")
    return rows.select("track_id", "region", "label", F.coalesce(same, F.lit(False)).alias("same"))


@query(
    "regression_metrics",
    O.sql(
        """select count(*) as n, round(sqrt(sum((label - prediction) * (label - prediction)) / count(*)), 9) as rmse,
                  round(sum(abs(label - prediction)) / count(*), 9) as mae,
                  round(1 - sum((label - prediction) * (label - prediction))
                      / sum((label - m) * (label - m)), 9) as r2
           from (select t.label, r.prediction, avg(t.label) over () as m
                 from splitted t join (select region, avg(label) as prediction from splitted
                                       where split = 'train' group by region) r using (region)
                 where t.split = 'test')""",
        **MODEL_CTES,
    ),
)
def _regression_metrics(c: DataFrame) -> DataFrame:
    """RMSE, MAE, R^2 of a closed-form predictor (train-split regional mean rank)."""
    data = Q.model_data(c)
    means = Q.split_of(data, "train").groupBy("region").agg(F.avg("label").alias("prediction"))
    return model.regression_metrics(Q.split_of(data, "test").join(means, "region"), digits=9)


@query("feature_importance")
def _feature_importance(c: DataFrame) -> DataFrame:
    """Forest feature importances, largest first, with the 0.05 cutoff flag."""
    return model.feature_importance(Q.q5_forest(c)[0])


@query("coefficient_table", COEFFICIENTS_SQL)
def _coefficient_table(c: DataFrame) -> DataFrame:
    """Linear model coefficients with standard errors, t and p values (R9), to six places."""
    return model.coefficient_table(Q.q5_linear(c)[0], digits=DIGITS)


# Statements about the fitted models that hold whatever the fit, as rows that SQL can give.
FEATURE_VALUES = ", ".join(f"({i}, '{c}')" for i, c in enumerate(["explicit", *AUDIO_FEATURES]))


@query(
    "importance_identities",
    f"""select "index", feature, true as not_negative, 1.0e0 as total
        from (values {FEATURE_VALUES}) v("index", feature)""",
)
def _importance_identities(c: DataFrame) -> DataFrame:
    """Forest importances: one per feature, none negative, summing to 1."""
    table = model.feature_importance(Q.q5_forest(c)[0])
    total = F.round(F.sum("importance").over(Window.partitionBy()), 9)
    return table.select("index", "feature", (F.col("importance") >= 0).alias("not_negative"), total.alias("total"))


@query(
    "coefficient_identities",
    f"""select "index", feature, true as t_is_ratio, true as p_in_range
        from (values {FEATURE_VALUES}, ({len(AUDIO_FEATURES) + 1}, 'intercept')) v("index", feature)""",
)
def _coefficient_identities(c: DataFrame) -> DataFrame:
    """Coefficient table: t is coefficient over standard error, p a probability.

    Without a standard error above 0 there is no ratio: t is then NULL, and so may p be.
    """
    return coefficient_identities(model.coefficient_table(Q.q5_linear(c)[0]))


def coefficient_identities(table: DataFrame) -> DataFrame:
    ratio = F.try_divide("coefficient", "std_error")
    same = F.abs(F.col("t_value") - ratio) <= 1e-9 * (1 + F.abs("t_value"))
    undefined = F.col("t_value").isNull() & ratio.isNull()
    in_range = F.coalesce(F.col("p_value").between(0, 1), undefined)
    return table.select("index", "feature", F.coalesce(same, undefined).alias("t_is_ratio"), in_range.alias("p_in_range"))


@query(
    "linear_normal_equations",
    O.sql(
        f"""select "index", feature, true as residuals_orthogonal, n
            from (values {FEATURE_VALUES}, ({len(AUDIO_FEATURES) + 1}, 'intercept')) v("index", feature),
                 (select count(*) as n from splitted where split = 'train')""",
        **MODEL_CTES,
    ),
)
def _linear_normal_equations(c: DataFrame) -> DataFrame:
    """Training residuals are orthogonal to every feature and the intercept: the least-squares solution.

    Each sum of residual x feature is at most 1e-8 of the sum of their absolute values.
    """
    data = Q.assembled_data(c)
    fitted, _ = Q.q5_linear(c, data)
    rows = fitted.transform(Q.split_of(data, "train")).withColumn("r", F.col("label") - F.col("prediction"))
    inputs = {f: F.col(f).cast("double") for f in MODEL_FEATURES} | {"intercept": F.lit(1.0)}
    sums = [
        (F.abs(F.sum(F.col("r") * x)) <= 1e-8 * F.sum(F.abs("label") * (F.abs(x) + 1))).alias(f"o{i}")
        for i, x in enumerate(inputs.values())
    ]
    wide = rows.agg(F.count(F.lit(1)).alias("n"), *sums)
    stacked = ", ".join(f"{i}, '{f}', o{i}" for i, f in enumerate(inputs))
    return wide.selectExpr("n", f"stack({len(inputs)}, {stacked}) as (index, feature, residuals_orthogonal)")


@query(
    "forest_identities",
    O.sql(
        """select track_id, region, label, true as in_train_range from splitted where split = 'test'""",
        **MODEL_CTES,
    ),
)
def _forest_identities(c: DataFrame) -> DataFrame:
    """Forest predictions: one per test row, each within the range of the training labels."""
    data = Q.assembled_data(c)
    _, predicted = Q.q5_forest(c, data)
    reach = Q.split_of(data, "train").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    low, high = reach.first()
    return predicted.select("track_id", "region", "label", F.col("prediction").between(low, high).alias("in_train_range"))


# ---------------------------------------------------------------- files and streaming ingest
def _read_charts_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart rows written as CSV shards with other columns between, in another order, with quotes and
    commas inside fields, and read by name with ``read_charts`` (S1)."""
    shards = fresh_path(spark, "named-shards")
    rows = chart_rows(spark, sf_dir)
    quoted = rows.withColumn("title", F.concat(F.lit('Say "Hi", '), "title"))
    quoted = quoted.withColumn("extra", F.concat(F.lit("x, "), "track_id"))
    order = ["extra", *reversed(CHART_COLUMNS), "long_date"]
    quoted.select(*order).write.options(header=True, quote='"', escape='"').csv(shards)
    return typed_charts(read_charts(spark, f"{shards}/*.csv")).select(*TYPED, "_corrupt_record")


QUERIES["read_charts_by_name"] = _read_charts_by_name
O.register(
    "read_charts_by_name",
    O.sql(
        f"""select {TYPED_SQL.replace("title,", "'Say \"Hi\", ' || title as title,", 1)},
                   cast(null as varchar) as _corrupt_record from chart"""
    ),
)


def _read_unlike_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart rows written as CSV shards with three orders of columns in one folder, read in one call by
    ``read_charts`` (S1)."""
    shards = fresh_path(spark, "unlike-shards")
    rows = chart_rows(spark, sf_dir).drop("long_date").withColumn("extra", F.concat(F.lit("x, "), "track_id"))
    orders = [CHART_COLUMNS, ["extra", *reversed(CHART_COLUMNS)], [*CHART_COLUMNS[7:], "extra", *CHART_COLUMNS[:7]]]
    for i, order in enumerate(orders):
        part = rows.where(F.col("rank") % len(orders) == i).select(*order)
        part.write.mode("append").options(header=True, quote='"', escape='"').csv(shards)
    return typed_charts(read_charts(spark, f"{shards}/*.csv", unlike_headers=True)).select(*TYPED, "_corrupt_record")


QUERIES["read_unlike_headers"] = _read_unlike_headers
O.register("read_unlike_headers", O.sql(f"select {TYPED_SQL}, cast(null as varchar) as _corrupt_record from chart"))


def _streamed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV shards ingested by two runs with default arguments, half of the shards new to the second:
    every row once (S1 incremental form)."""
    from chartlens.streaming import ingest_chart_shards

    shards, table = fresh_path(spark, "twice-shards"), fresh_path(spark, "twice-table")
    rows = chart_rows(spark, sf_dir).drop("long_date")
    for kept in (F.col("rank") % 2 == 0, F.col("rank") % 2 == 1):
        rows.where(kept).write.mode("append").option("header", True).csv(shards)
        ingest_chart_shards(spark, shards, table).awaitTermination()
    return spark.read.parquet(table).select(*TYPED)


QUERIES["streamed_twice"] = _streamed_twice
O.register("streamed_twice", O.sql(f"select {TYPED_SQL} from chart"))


def _streamed_unlike_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV shards of three column orders in one folder, one with a column more, ingested by a run without
    and one with ``unlike_headers``: every row once, by its shard's own names (S1)."""
    from chartlens.streaming import ingest_chart_shards

    shards, table = fresh_path(spark, "unlike-shards"), fresh_path(spark, "unlike-table")
    rows = chart_rows(spark, sf_dir).drop("long_date")
    names = rows.columns
    orders = [names, ["other", *reversed(names)], [*names[5:], *names[:5]]]
    for n, order in enumerate(orders):
        part = rows.where((F.col("rank") % 3 == n) if n else F.coalesce(F.col("rank") % 3 == 0, F.lit(True)))
        part = part.withColumn("other", F.lit("1,2")).select(*order)
        part.write.mode("append").option("header", True).csv(shards)
        if n != 1:
            ingest_chart_shards(spark, shards, table, unlike_headers=n > 0).awaitTermination()
    return spark.read.parquet(table).select(*TYPED)


QUERIES["streamed_unlike_headers"] = _streamed_unlike_headers
O.register("streamed_unlike_headers", O.sql(f"select {TYPED_SQL} from chart"))


def _streamed_chart_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart rows written as CSV shards, ingested by the streaming file source
    into the typed chart table, and read back (S1 incremental form)."""
    from chartlens.streaming import ingest_chart_shards

    shards = fresh_path(spark, "chart-shards")
    chart_rows(spark, sf_dir).drop("long_date").write.option("header", True).csv(shards)
    table = fresh_path(spark, "chart-table")
    ingest_chart_shards(spark, shards, table).awaitTermination()
    return spark.read.parquet(table).select(*TYPED)


QUERIES["streamed_chart_table"] = _streamed_chart_table
O.register("streamed_chart_table", O.sql(f"select {TYPED_SQL} from chart"))


# ---------------------------------------------------------------- fused forms used by the report jobs
@query("artist_bridge", O.sql("select * from bridge", **ARTIST_CTES))
def _artist_bridge(c: DataFrame) -> DataFrame:
    """Distinct (track, region, artist) with the pair's first chart day (A2 bridge)."""
    return artists.artist_bridge(Q.artist_rows(c))


@query(
    "tier_flags",
    O.sql(
        """select t.track_id, t.region, min(t.first_chart_day) as first_chart_day,
                  bool_or(r.tier = 'top') as in_top, bool_or(r.tier = 'middle') as in_middle,
                  bool_or(r.tier = 'bottom') as in_bottom
           from bridge t join tiers r on t.artist = r.artist group by t.track_id, t.region""",
        **ARTIST_CTES,
    ),
)
def _tier_flags(c: DataFrame) -> DataFrame:
    """Per (track, region): first chart day and membership flag per tier (A5, one row per pair)."""
    bridge, tiers = Q.tier_inputs(c)
    return artists.tier_flags(bridge, tiers)


@query(
    "track_region_summary",
    O.sql(
        """select tr.track_id, tr.region, tr.release_day, tr.first_chart_day, tr.chart_entries, s.days_in_chart
           from tr join streak s using (track_id, region)""",
        **STREAK_CTES,
    ),
)
def _track_region_summary(c: DataFrame) -> DataFrame:
    """Release day, first chart day, entries and streak per (track, region) in one pass (L1 + L5)."""
    return lifecycle.track_region_summary(Q.lifecycle_base(c))


@query(
    "genre_month_stats",
    O.sql(
        """select region, month, genre, count(*) as record_count, avg(af_danceability) as avg_danceability,
                  avg(af_energy) as avg_energy
           from g group by region, month, genre""",
        **GENRE_CTES,
    ),
)
def _genre_month_stats(c: DataFrame) -> DataFrame:
    """Rows and mean danceability/energy per region, month and genre (G3 + G6 in one aggregation)."""
    return genres.genre_month_stats(genre_rows_of(c))


@query("forest_metrics")
def _forest_metrics(c: DataFrame) -> DataFrame:
    """RMSE, MAE, R^2 of the random forest on the test split (R5 + R7); rows-only check."""
    return model.regression_metrics(Q.q5_forest(c)[1])


@query(
    "linear_metrics",
    O.sql(
        f"""select count(*) as n, round(sqrt(sum((label - prediction) * (label - prediction)) / count(*)), {DIGITS}) as rmse,
                   round(sum(abs(label - prediction)) / count(*), {DIGITS}) as mae,
                   round(1 - sum((label - prediction) * (label - prediction)) / sum((label - m) * (label - m)), {DIGITS}) as r2
            from (select *, avg(label) over () as m from predicted)""",
        **PREDICTED_CTES,
    ),
)
def _linear_metrics(c: DataFrame) -> DataFrame:
    """RMSE, MAE, R^2 of the linear model on the test split (R6 + R7), to six places."""
    return model.regression_metrics(Q.q5_linear(c)[1], digits=DIGITS)


# ---------------------------------------------------------------- the growing fixture: named reports and the flagship plans
@growing_query(
    "named_tier_corridors",
    O.sql(
        "select case from_region "
        + " ".join(f"when '{o}' then '{n}'" for o, n in TIER_ORIGIN_NAMES.items())
        + f""" end || '_' || tier as report, to_region, avg(days_to_popular) as avg_days_to_popular
              from days where from_region in ({_in_list(TIER_ORIGINS)}) group by from_region, tier, to_region""",
        **ARTIST_CTES,
    ),
)
def _named_tier_corridors(c: DataFrame) -> DataFrame:
    """The nine corridor reports per named origin and tier (M7)."""
    names = F.create_map(*[F.lit(x) for pair in TIER_ORIGIN_NAMES.items() for x in pair])
    rows = Q.q4_corridors(c, TIER_ORIGINS)
    report = F.concat(names[F.col("from_region")], F.lit("_"), "tier")
    return rows.select(report.alias("report"), "to_region", "avg_days_to_popular")


@growing_query(
    "named_title_corridors",
    O.sql(
        "select case from_region "
        + " ".join(f"when '{o}' then '{n}'" for o, n in TITLE_ORIGIN_NAMES.items())
        + f""" end as report, to_region, round(avg(days_to_popular), 0) as avg_days_to_popular
              from t_edges where from_region in ({_in_list(TITLE_ORIGINS)}) group by from_region, to_region""",
        **TITLE_CTES,
    ),
)
def _named_title_corridors(c: DataFrame) -> DataFrame:
    """The five corridor reports per named origin (M8)."""
    names = F.create_map(*[F.lit(x) for pair in TITLE_ORIGIN_NAMES.items() for x in pair])
    rows = Q.q3_corridors(c, TITLE_ORIGINS)
    return rows.select(names[F.col("from_region")].alias("report"), "to_region", "avg_days_to_popular")


growing_query("growing_artist_tiers", O.ORACLE["artist_tiers"])(_artist_tiers)
growing_query("growing_tiers_by_count", O.ORACLE["tiers_by_count"])(_tiers_by_count)
growing_query("growing_delay_by_region", O.ORACLE["delay_by_region"])(_delay_by_region)
growing_query("growing_streak_by_region", O.ORACLE["streak_by_region"])(_streak_by_region)
growing_query("growing_spread_by_destination", O.ORACLE["spread_by_destination"])(_spread_by_destination)
@growing_query(
    "growing_track_counts",
    O.sql("select region, count(distinct track_id) as n_tracks, true as within_error from chart group by region"),
)
def _growing_track_counts(c: DataFrame) -> DataFrame:
    """Distinct tracks per region, exact, and whether merged monthly sketches come within four standard errors."""
    exact = c.groupBy("region").agg(F.count_distinct("track_id").alias("n_tracks"))
    sketched = genres.sketched_count(Q.month_sketches(c, "track_id", ["region"]), ["region"], "estimate")
    off = F.abs(F.col("s.estimate") - F.col("e.n_tracks"))
    both = exact.alias("e").join(sketched.alias("s"), F.col("e.region").eqNullSafe(F.col("s.region")))
    return both.select("e.region", "n_tracks", (off <= 4 * genres.sketch_error() * F.col("n_tracks")).alias("within_error"))


growing_query("growing_title_edges", O.ORACLE["title_edges"])(_title_edges)
growing_query("growing_chart_day_spread", O.ORACLE["chart_day_spread"])(_chart_day_spread)
growing_query("growing_model_frame", O.ORACLE["model_frame"])(_model_frame)


# ---------------------------------------------------------------- funnels, annotated rows
@query(
    "tier_funnel",
    O.sql(
        """select 'all' as level, 0 as step_no, 'released after 2017-01-01' as step, count(*) as row_count from top
           union all select 'all', 1, 'track-regions', count(*) from tr
           union all select 'all', 2, 'track-regions with artists, one per artist', count(*) from bridge
           union all select 'all', 3, 'artists', count(*) from counts
           union all select tier, 4, 'artists', count(*) from tiers group by tier
           union all select tier, 5, 'track-regions', count(*) from tier_tr group by tier""",
        **ARTIST_CTES,
    ),
)
def _tier_funnel(c: DataFrame) -> DataFrame:
    """Sizes along the tier question (S3)."""
    return Q.tier_funnel(c)


@query(
    "model_funnel",
    O.sql(
        """select 'rows' as level, 0 as step_no, 'input' as step, count(*) as row_count from chart
           union all select 'rows', 1, 'chart is top200', count(*) from chart where chart = 'top200'
           union all select 'rows', 2, 'released after 2017-01-01', count(*) from top
           union all select 'track_regions', 0, 'input', count(*) from frame
           union all select 'track_regions', 1, 'features and peak rank known', count(*) from complete
           union all select 'track_regions', 2, 'train', count(*) from splitted where split = 'train'""",
        **MODEL_CTES,
    ),
)
def _model_funnel(c: DataFrame) -> DataFrame:
    """Rows left along the model question (S3)."""
    return Q.model_funnel(c)


@query(
    "annotated_rows",
    O.sql("select track_id, region, rank, long_date, genre, month from a", **(GENRE_CTES | dict(
        a=GENRE_CTES["g"].replace("select region, long_date,", "select track_id, rank, region, long_date,"),
        g0=GENRE_CTES["g0"].replace("select region,", "select track_id, rank, region,"),
    ))),
)
def _annotated_rows(c: DataFrame) -> DataFrame:
    """Every chart row with its genre and month (G1 + G2), the row-level genre dataset."""
    return Q.annotated_rows(c, GENRE_DATE).select("track_id", "region", "rank", "long_date", "genre", "month")

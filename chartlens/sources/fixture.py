"""Chart rows derived from the driver's TPC-H-style test tables.

The reference reads one wide chart table that is not shipped. For testing
and benchmarking we derive rows of the same schema from the test tables
(one chart row per line item), following the rule written down in
FIXTURES.md section 2. This module only shapes input rows; none of the
analysis happens here, and no operator relies on how these rows are made.

The same rule as SQL (for the DuckDB oracle) is ``CHART_VIEW_SQL``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlens.schema import CHART_COLUMNS

_BASE_DAY = dt.date(2017, 1, 1)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Regions that some nations of the test tables stand for in the
# growing fixture, so that the named-origin reports have rows.
REGION_OF_NATION = {
    "NATION_0": "France",
    "NATION_1": "Japan",
    "NATION_2": "United Kingdom",
    "NATION_3": "Luxembourg",
    "NATION_4": "Dominican Republic",
    "NATION_5": "Global",
}


def growing_chart_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart rows whose tracks, titles and artists grow with the tables.

    As ``chart_rows``, but a track is a part (not one of 200), two parts share a title, three an
    artist, every seventh part has a second artist, and six nations carry the
    names of regions that the named-origin reports ask for.
    """
    rows = chart_rows(spark, sf_dir, fold_keys=False)
    names = F.create_map(*[F.lit(x) for pair in REGION_OF_NATION.items() for x in pair])
    return rows.withColumn("region", F.coalesce(names[F.col("region")], F.col("region")))


def chart_rows(spark: SparkSession, sf_dir: str, fold_keys: bool = True) -> DataFrame:
    """Chart rows (``CHART_SCHEMA`` plus ``long_date``) from the test tables.

    Joins line items to orders, customers, nations and parts. Only the
    columns used below are read (Catalyst prunes the parquet scans).
    ``nation`` is broadcast: TPC-H fixes it at 25 rows at every scale
    factor. The other joins are left to the planner (sort-merge, or
    broadcast when AQE measures a small side).
    """
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_shipdate"
    )
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = _table(spark, sf_dir, "part").select("p_partkey")

    s = (
        li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            (F.col("p_partkey") % 200 if fold_keys else F.col("p_partkey")).alias("k"),
            F.col("n_name").alias("region"),
            F.when(F.col("l_returnflag") == "R", "viral50").otherwise("top200").alias("chart"),
            (1 + (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 200).alias("rnk"),
            (
                (F.year("l_shipdate") - 1995) * 372
                + (F.month("l_shipdate") - 1) * 31
                + F.dayofmonth("l_shipdate")
                - 1
            ).alias("d"),
        )
    )
    k = F.col("k")

    def frac(mult: int, mod: int, div: float):
        return ((k * mult) % mod) / F.lit(div)

    artist = (
        F.when(k % 41 == 5, F.lit(None).cast("string"))
        .when(
            k % 3 == 0,
            F.concat(F.lit("A"), (k % 30).cast("string"), F.lit(", A"), ((k * 7 + 3) % 53).cast("string")),
        )
        .otherwise(F.concat(F.lit("A"), ((k * k) % 47).cast("string")))
    )
    title = F.concat(F.lit("Title "), (k % 150 if fold_keys else F.floor(k / 2)).cast("string"))
    if not fold_keys:
        first = F.concat(F.lit("A"), F.floor(k / 3).cast("string"))
        artist = F.when(k % 41 == 5, F.lit(None).cast("string")).when(
            k % 7 == 0, F.concat(first, F.lit(", B"), F.floor(k / 70).cast("string"))
        ).otherwise(first)
    release = (
        F.when(k % 20 == 0, F.lit("2017"))
        .when(k % 20 == 1, F.lit("0000"))
        .when(k % 20 == 2, F.lit(None).cast("string"))
        .when(k % 20 == 3, F.lit("2017-02"))
        .otherwise(F.date_add(F.lit(dt.date(2016, 12, 25)), (k % 60).cast("int")).cast("string"))
    )
    out = s.select(
        F.concat(F.lit("T"), k.cast("string")).alias("track_id"),
        title.alias("title"),
        artist.alias("artist"),
        "region",
        "chart",
        F.col("rnk").cast("int").alias("rank"),
        F.date_add(F.lit(_BASE_DAY), (F.col("d") % 90).cast("int")).alias("date"),
        F.date_add(F.lit(_BASE_DAY), F.col("d").cast("int")).alias("long_date"),
        release.alias("release_date"),
        (k % 7 == 0).alias("explicit"),
        F.when(k % 37 == 4, F.lit(None).cast("double")).otherwise(frac(37, 101, 100.0)).alias("af_danceability"),
        frac(53, 97, 96.0).alias("af_energy"),
        (k % 12).cast("double").alias("af_key"),
        (F.lit(0.0) - ((k * 29) % 89) / F.lit(4.0)).alias("af_loudness"),
        (k % 2).cast("double").alias("af_mode"),
        frac(31, 83, 82.0).alias("af_speechiness"),
        frac(43, 79, 78.0).alias("af_acousticness"),
        frac(17, 73, 72.0).alias("af_instrumentalness"),
        frac(61, 71, 70.0).alias("af_liveness"),
        frac(13, 67, 66.0).alias("af_valence"),
        (F.lit(60.0) + (k * 59) % 103).alias("af_tempo"),
        (F.lit(3.0) + k % 3).alias("af_time_signature"),
    )
    return out.select(*CHART_COLUMNS, "long_date")


# The same rule as one SQL text (FIXTURES.md section 2), used by the DuckDB
# oracle over the pre-registered test-table views.
CHART_VIEW_SQL = """
select
  'T' || cast(k as string) as track_id,
  'Title ' || cast(k % 150 as string) as title,
  case when k % 41 = 5 then null
       when k % 3 = 0 then 'A' || cast(k % 30 as string) || ', A' || cast((k * 7 + 3) % 53 as string)
       else 'A' || cast((k * k) % 47 as string) end as artist,
  region,
  chart,
  cast(rnk as int) as rank,
  date '2017-01-01' + cast(d % 90 as int) as date,
  date '2017-01-01' + cast(d as int) as long_date,
  case k % 20 when 0 then '2017' when 1 then '0000' when 2 then null when 3 then '2017-02'
       else cast(date '2016-12-25' + cast(k % 60 as int) as string) end as release_date,
  (k % 7) = 0 as explicit,
  case when k % 37 = 4 then null else ((k * 37) % 101) / 100.0e0 end as af_danceability,
  ((k * 53) % 97) / 96.0e0 as af_energy,
  cast(k % 12 as double) as af_key,
  0e0 - ((k * 29) % 89) / 4.0e0 as af_loudness,
  cast(k % 2 as double) as af_mode,
  ((k * 31) % 83) / 82.0e0 as af_speechiness,
  ((k * 43) % 79) / 78.0e0 as af_acousticness,
  ((k * 17) % 73) / 72.0e0 as af_instrumentalness,
  ((k * 61) % 71) / 70.0e0 as af_liveness,
  ((k * 13) % 67) / 66.0e0 as af_valence,
  60.0e0 + (k * 59) % 103 as af_tempo,
  3.0e0 + k % 3 as af_time_signature
from (
  select p_partkey % 200 as k,
         n_name as region,
         case when l_returnflag = 'R' then 'viral50' else 'top200' end as chart,
         1 + (l_orderkey * 7 + l_linenumber) % 200 as rnk,
         (extract(year from l_shipdate) - 1995) * 372
           + (extract(month from l_shipdate) - 1) * 31
           + extract(day from l_shipdate) - 1 as d
  from lineitem
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey
  join part on l_partkey = p_partkey
) s
"""


# The growing fixture as SQL: the same text with its own keys and regions.
GROWING_VIEW_SQL = (
    CHART_VIEW_SQL.replace("p_partkey % 200 as k", "p_partkey as k")
    .replace("cast(k % 150 as string)", "cast(k // 2 as string)")
    .replace(
        """when k % 3 = 0 then 'A' || cast(k % 30 as string) || ', A' || cast((k * 7 + 3) % 53 as string)
       else 'A' || cast((k * k) % 47 as string) end""",
        """when k % 7 = 0 then 'A' || cast(k // 3 as string) || ', B' || cast(k // 70 as string)
       else 'A' || cast(k // 3 as string) end""",
    )
    .replace(
        "n_name as region",
        "case n_name " + " ".join(f"when '{n}' then '{r}'" for n, r in REGION_OF_NATION.items()) + " else n_name end as region",
    )
)

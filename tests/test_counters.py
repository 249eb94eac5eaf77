"""Funnels counted on the side, and how many scans of the chart rows the report job makes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from chartlens.operators.clean import filter_funnel
from chartlens.operators.counters import SideCounter
from chartlens.plans import questions as Q
from chartlens.plans.registry import charts_of
from chartlens.plans.reports import write_all_reports
from tests.conftest import SF_SMALL

STEPS = [("even", lambda: F.col("id") % 2 == 0), ("large", lambda: F.col("id") > 500)]


def steps():
    return [(n, c()) for n, c in STEPS]


def run(df):
    df.write.format("noop").mode("overwrite").save()


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_counts_ride_on_a_shuffle_job(spark):
    df = spark.range(1000).repartition(7)
    counter = SideCounter(df, steps(), also={"third": F.col("id") % 3 == 0})
    run(counter.rows.where("id > 10").groupBy((F.col("id") % 3).alias("k")).count())
    assert rows(counter.funnel()) == rows(filter_funnel(df, steps()))
    assert counter.other("third") == 334 and not counter.rescanned
    assert counter.rows.columns == df.columns


@pytest.mark.parametrize("empty", ["range", "rows"])
def test_no_rows(spark, empty):
    df = spark.range(0) if empty == "range" else spark.createDataFrame([], "id long")
    counter = SideCounter(df, steps())
    run(counter.rows.groupBy("id").count())
    assert counter.counts() == [0, 0, 0]


def test_partitions_that_count_twice_are_noticed(spark):
    """Sampling for range bounds reads the rows once more inside one job, as a repeated stage does."""
    df = spark.range(1000, numPartitions=5)
    counter = SideCounter(df, steps())
    run(counter.rows.repartitionByRange(4, "id"))
    assert counter._observation.get["c0"] > 1000
    assert counter.counts() == [1000, 500, 249] and counter.rescanned


def test_null_conditions_fail(spark):
    df = spark.createDataFrame([(None,), (2,), (3,)], "id int")
    counter = SideCounter(df, steps())
    run(counter.rows)
    assert counter.counts() == [3, 1, 0]


def test_report_job_scans_the_charts_five_times(spark, tmp_path):
    table = charts_of(spark, SF_SMALL)
    n = table.count()
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    charts = table.mapInArrow(watched, table.schema)
    write_all_reports(charts, str(tmp_path / "out"), genre_date="long_date")
    assert seen.value == 5 * n
    read = lambda name: rows(spark.read.option("header", True).csv(str(tmp_path / "out" / name)))
    for name, question in (("filter_funnel", Q.funnel), ("tier_funnel", Q.tier_funnel), ("model_funnel", Q.model_funnel)):
        want = [tuple(str(x) for x in r) for r in question(table).collect()]
        assert read(name) == sorted(want), name


def test_files_with_malformed_rows(spark, tmp_path):
    """The first step of charts from files leaves out their malformed rows."""
    from chartlens.sources import read_charts, typed_charts

    raw = charts_of(spark, SF_SMALL).drop("release_day", "long_date").withColumn("rank", F.col("rank").cast("string"))
    n = raw.count()
    raw.withColumn("rank", F.when(F.col("rank") == "7", "seven").otherwise(F.col("rank"))).write.option("header", True).csv(str(tmp_path / "csv"))
    found = {r["step"]: r["row_count"] for r in Q.funnel(typed_charts(read_charts(spark, str(tmp_path / "csv")))).collect() if r["level"] == "rows"}
    assert found["input"] == n
    assert found["well formed"] == raw.where("rank != '7'").count() < n

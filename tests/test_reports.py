"""The report jobs and the command line, end to end on small tables."""

from __future__ import annotations

import os

from chartlens.__main__ import main
from chartlens.plans.reports import write_all_reports
from chartlens.plans.registry import charts_of
from tests.conftest import SF_MID, SF_SMALL


def test_write_all_reports(spark, tmp_path):
    c = charts_of(spark, SF_SMALL)
    paths = write_all_reports(c, str(tmp_path / "out"), genre_date="long_date")
    names = {os.path.basename(p) for p in paths}
    assert {"question1", "question2", "artist_popularity_top", "france_middle", "UK_bottom", "luxembourg",
            "best_genres_per_month_per_region", "forest_metrics", "linear_coefficients"} <= names
    q1 = spark.read.option("header", True).csv(str(tmp_path / "out" / "question1"))
    assert q1.count() == 25


def test_cli_ingest_and_reports(spark, tmp_path):
    c = charts_of(spark, SF_SMALL).drop("release_day", "long_date")
    csv_dir = tmp_path / "csv"
    c.write.option("header", True).csv(str(csv_dir))
    table = str(tmp_path / "table")
    main(["ingest", "--input", str(csv_dir), "--table", table])
    main(["reports", "--table", table, "--out", str(tmp_path / "rep"), "--questions", "delay_streak", "titles"])
    assert spark.read.option("header", True).csv(str(tmp_path / "rep" / "question2")).count() == 25
    main(["reports", "--input", str(csv_dir), "--out", str(tmp_path / "rep2"), "--questions", "delay_streak"])
    a = spark.read.option("header", True).csv(str(tmp_path / "rep" / "question1")).collect()
    b = spark.read.option("header", True).csv(str(tmp_path / "rep2" / "question1")).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_parallel_and_sequential_reports_agree(spark, tmp_path):
    from chartlens.plans.reports import write_reports

    c = charts_of(spark, SF_SMALL)
    qs = ["delay_streak", "titles", "genres"]
    a = write_reports(c, str(tmp_path / "seq"), qs, genre_date="long_date", parallel=False)
    b = write_reports(c, str(tmp_path / "par"), qs, genre_date="long_date", parallel=True)
    assert sorted(os.path.basename(p) for p in a) == sorted(os.path.basename(p) for p in b)
    for p in a:
        name = os.path.basename(p)
        x = spark.read.option("header", True).csv(p).collect()
        y = spark.read.option("header", True).csv(str(tmp_path / "par" / name)).collect()
        assert sorted(map(tuple, x)) == sorted(map(tuple, y)), name


def test_cli_parquet_reports(spark, tmp_path):
    c = charts_of(spark, SF_SMALL).drop("release_day", "long_date")
    csv_dir = tmp_path / "csv"
    c.write.option("header", True).csv(str(csv_dir))
    main(["reports", "--input", str(csv_dir), "--out", str(tmp_path / "pq"), "--questions", "delay_streak",
          "--format", "parquet"])
    got = spark.read.parquet(str(tmp_path / "pq" / "question1"))
    from chartlens.plans import questions as Q
    from chartlens.sources import typed_charts

    want = Q.q1_delay(typed_charts(c))
    assert got.schema == want.schema
    assert sorted(got.collect()) == sorted(want.collect())


def test_reports_leave_no_scratch(spark, tmp_path):
    from chartlens.plans.reports import write_reports
    from chartlens.session import app_dir

    def entries():
        return set(os.listdir(app_dir(spark))) if os.path.isdir(app_dir(spark)) else set()

    before = entries()
    c = charts_of(spark, SF_SMALL)
    names = write_reports(c, str(tmp_path / "out"), genre_date="long_date")
    assert entries() == before
    assert {"tier_funnel", "model_funnel", "filter_funnel", "genre_rows", "region_count", "linear_formula"} <= {
        os.path.basename(n) for n in names
    }
    read = lambda n: spark.read.option("header", True).csv(str(tmp_path / "out" / n))
    assert read("genre_rows").count() == c.count()
    assert read("region_count").first()[0] == "25"
    assert read("linear_formula").first()[0].startswith("highest_ranking = ")


def test_named_reports_have_rows(spark, tmp_path):
    from chartlens.plans.reports import TIER_ORIGIN_NAMES, TITLE_ORIGIN_NAMES, write_reports
    from chartlens.schema import TIERS
    from chartlens.sources import growing_chart_rows, typed_charts

    c = typed_charts(growing_chart_rows(spark, SF_MID))
    write_reports(c, str(tmp_path / "tiers"), ["tiers"])
    write_reports(c, str(tmp_path / "titles"), ["titles"])
    names = [f"tiers/{o}_{t}" for o in TIER_ORIGIN_NAMES.values() for t in TIERS]
    names += [f"titles/{o}" for o in TITLE_ORIGIN_NAMES.values()]
    for name in names:
        rows = spark.read.option("header", True).csv(str(tmp_path / name)).collect()
        assert rows and rows[0].__fields__ == ["to_region", "avg_days_to_popular"], name

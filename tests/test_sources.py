"""Chart sources: typed table round trip, parquet reader, partition layout."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from chartlens.plans.registry import charts_of
from chartlens.schema import CHART_COLUMNS
from chartlens.sources import read_chart_table, read_charts, typed_charts, write_chart_table
from chartlens.sources.charts import chart_columns
from tests.conftest import SF_SMALL


def rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_typed_table_round_trip(spark, tmp_path):
    c = charts_of(spark, SF_SMALL)
    path = str(tmp_path / "table")
    write_chart_table(c, path)
    assert sorted(d for d in os.listdir(path) if d.startswith("chart=")) == ["chart=top200", "chart=viral50"]
    back = read_chart_table(spark, path)
    cols = [*CHART_COLUMNS, "release_day"]
    assert dict(back.select(*cols).dtypes) == dict(c.select(*cols).dtypes)
    assert rows(back, cols) == rows(c, cols)


def test_parquet_reader_types_raw_files(spark, tmp_path):
    raw = charts_of(spark, SF_SMALL).select(*CHART_COLUMNS)
    path = str(tmp_path / "raw")
    raw.write.parquet(path)
    back = typed_charts(read_charts(spark, path, fmt="parquet"))
    assert rows(back, [*CHART_COLUMNS, "release_day"]) == rows(typed_charts(raw), [*CHART_COLUMNS, "release_day"])


def test_table_files_are_sorted_by_release_day(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    path = str(tmp_path / "table")
    write_chart_table(charts_of(spark, SF_SMALL), path)
    files = glob.glob(f"{path}/chart=*/*.parquet")
    assert files
    for f in files:
        days = [d for d in pq.read_table(f, columns=["release_day"]).column(0).to_pylist() if d is not None]
        assert days == sorted(days)


LINE = {c: "" for c in CHART_COLUMNS} | {
    "track_id": "t1", "title": "Song", "artist": "A, B", "region": "X", "chart": "top200", "rank": "1",
    "date": "2018-01-02", "release_date": "2017-05-01", "explicit": "False", "af_energy": "0.5",
}


def write_csv(path, names, rows):
    def field(v):
        return '"' + v.replace('"', '""') + '"' if any(c in v for c in ',"\n') else v

    lines = [",".join(names)] + [r if isinstance(r, str) else ",".join(field(r.get(n, "")) for n in names) for r in rows]
    path.write_text("\n".join(lines) + "\n")


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    names = ["extra", *reversed(CHART_COLUMNS), "other"]
    write_csv(tmp_path / "a.csv", names, [LINE, LINE | {"title": 'Say "Hi", now', "extra": "1,2"}])
    r1, r2 = sorted(read_charts(spark, str(tmp_path / "a.csv")).collect(), key=lambda r: r.title)[::-1]
    assert (r1.track_id, r1.artist, r1.region, r1["rank"], str(r1.date), r1.explicit, r1.af_energy) == (
        "t1", "A, B", "X", 1, "2018-01-02", False, 0.5
    )
    assert r1._corrupt_record is None and r2._corrupt_record is None
    assert r2.title == 'Say "Hi", now' and r2.region == "X"


def test_csv_line_breaks_in_fields(spark, tmp_path):
    write_csv(tmp_path / "a.csv", CHART_COLUMNS, [LINE | {"title": "two\nlines"}, LINE])
    got = read_charts(spark, str(tmp_path / "a.csv"), multi_line=True).collect()
    assert sorted(r.title for r in got) == ["Song", "two\nlines"]


def test_csv_headers_must_agree_or_be_listed_apart(spark, tmp_path):
    for d in ("a", "b"):
        (tmp_path / d).mkdir()
    write_csv(tmp_path / "a" / "1.csv", CHART_COLUMNS, [LINE])
    write_csv(tmp_path / "b" / "2.csv", list(reversed(CHART_COLUMNS)), [LINE | {"track_id": "t2"}])
    with pytest.raises(Exception, match="(?i)header"):
        read_charts(spark, str(tmp_path / "*" / "*.csv")).collect()
    both = read_charts(spark, [str(tmp_path / "a"), str(tmp_path / "b")]).collect()
    assert sorted((r.track_id, r.region) for r in both) == [("t1", "X"), ("t2", "X")]


def test_csv_missing_column_fails(spark, tmp_path):
    write_csv(tmp_path / "a.csv", [c for c in CHART_COLUMNS if c != "region"], [LINE])
    with pytest.raises(ValueError, match="region"):
        read_charts(spark, str(tmp_path / "a.csv"))


def test_malformed_rows_are_kept_and_counted(spark, tmp_path):
    from chartlens.plans import questions as Q

    rows = [LINE, "only one field", LINE | {"rank": "first"}, LINE | {"date": "someday"}, LINE | {"rank": "", "track_id": "t5"}]
    write_csv(tmp_path / "a.csv", CHART_COLUMNS, rows)
    charts = typed_charts(read_charts(spark, str(tmp_path / "a.csv")))
    assert charts.where("_corrupt_record is not null").count() == 3
    # the same when few columns are asked for
    assert charts.where("_corrupt_record is not null").select("region").count() == 3
    funnel = {(r.level, r.step): r.row_count for r in Q.funnel(charts).collect()}
    assert funnel[("rows", "input")] == 5 and funnel[("rows", "well formed")] == 2
    with pytest.raises(Exception, match="malformed"):
        read_charts(spark, str(tmp_path / "a.csv"), strict=True).collect()
    assert read_charts(spark, str(tmp_path / "a.csv")).count() == 5


def test_nan_features_are_missing(charts):
    from chartlens.operators import genres
    from chartlens.plans import questions as Q

    c = charts([dict(af_danceability=float("nan"), af_energy=0.2), dict(af_danceability=0.4, af_energy=0.4)])
    assert genres.genre_profile(Q.genre_rows(c).withColumn("genre", F.lit("g"))).first().avg_danceability == 0.4


def test_shared_folder_is_needed_on_a_cluster():
    from chartlens.session import shared_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_a_value_is_parsed_once(spark, tmp_path):
    """The check for malformed values and the NaN rule look at parsed values; both parsed them again before."""
    raw = spark.read.schema(", ".join(f"{c} string" for c in CHART_COLUMNS)).csv(str(tmp_path))
    plan = typed_charts(chart_columns(raw))._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"cast\(af_tempo#\d+ as double\)", plan)) == 1

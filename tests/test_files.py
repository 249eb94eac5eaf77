"""Shards with unlike headers in one folder, and reports that are replaced whole."""

from __future__ import annotations

import gzip
import os

import pytest
from pyspark.sql import functions as F

from chartlens.schema import CHART_COLUMNS
from chartlens.sources import read_charts, write_report
from chartlens.sources.charts import headers_of
from tests.test_sources import LINE, write_csv


def tracks(df):
    return sorted((r.track_id, r.region, r["rank"], r._corrupt_record) for r in df.collect())


def test_unlike_headers_in_one_folder(spark, tmp_path):
    write_csv(tmp_path / "1.csv", CHART_COLUMNS, [LINE])
    write_csv(tmp_path / "2.csv", ["extra", *reversed(CHART_COLUMNS)], [LINE | {"track_id": "t2", "extra": "1,2"}])
    write_csv(tmp_path / "3.csv", CHART_COLUMNS, [LINE | {"track_id": "t3"}, "only one field"])
    (tmp_path / "4.csv").write_text("")
    plain = tmp_path / "5.csv"
    write_csv(plain, list(reversed(CHART_COLUMNS)), [LINE | {"track_id": "t5"}])
    (tmp_path / "5.csv.gz").write_bytes(gzip.compress(plain.read_bytes()))
    plain.unlink()
    found = headers_of(spark, str(tmp_path / "*.csv*"))
    assert [len(v) for v in found.values()] == [1, 1, 2]  # Spark lists no empty file
    got = tracks(read_charts(spark, str(tmp_path / "*.csv*"), unlike_headers=True))
    assert [r[:3] for r in got if r[3] is None] == [("t1", "X", 1), ("t2", "X", 1), ("t3", "X", 1), ("t5", "X", 1)]
    assert len(got) == 5  # and the malformed row of the third file


def test_a_missing_column_still_fails(spark, tmp_path):
    write_csv(tmp_path / "1.csv", CHART_COLUMNS, [LINE])
    write_csv(tmp_path / "2.csv", [c for c in CHART_COLUMNS if c != "region"], [LINE])
    with pytest.raises(ValueError, match="region"):
        read_charts(spark, str(tmp_path), unlike_headers=True)
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "1.csv").write_text("")
    with pytest.raises(ValueError, match="no chart file"):
        read_charts(spark, str(tmp_path / "none"), unlike_headers=True)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_failed_report_leaves_the_old_one(spark, tmp_path, fmt):
    path = str(tmp_path / "reports" / "r")
    df = spark.range(10, numPartitions=3).withColumn("v", F.col("id") * 2)
    write_report(df, path, fmt)

    def read():
        return sorted(int(r["v"]) for r in spark.read.option("header", True).format(fmt).load(path).collect())

    assert read() == list(range(0, 20, 2))
    bad = df.withColumn("v", F.when(F.col("id") == 9, F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        write_report(bad, path, fmt)
    assert read() == list(range(0, 20, 2))
    write_report(df.where("id < 2"), path, fmt)
    assert read() == [0, 2]
    assert os.listdir(tmp_path / "reports") == ["r"]  # nothing staged or replaced is left
    with pytest.raises(ValueError):
        write_report(df, path, "xml")


def test_the_old_report_comes_back_if_the_swap_fails(spark, tmp_path):
    from chartlens.session import replace

    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "old").write_text("x")
    with pytest.raises(Exception):
        replace(spark, str(tmp_path / "nothing"), str(tmp_path / "r"))
    assert os.listdir(tmp_path / "r") == ["old"]

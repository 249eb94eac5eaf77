"""Incremental shard ingest: each shard lands once, typed, like the batch read."""

from __future__ import annotations

import pytest

from chartlens.schema import CHART_COLUMNS
from chartlens.sources import read_chart_table, read_charts, typed_charts
from chartlens.streaming import ingest, ingest_chart_shards
from tests.test_sources import LINE, write_csv

HEADER = ",".join(CHART_COLUMNS)


def shard(path, rows):
    path.write_text("\n".join([HEADER, *rows]) + "\n")


def row(track, day, release, chart="top200"):
    return f"{track},S,A,X,{chart},1,{day},{release},False,0.5,0.5,1.0,-5.0,1.0,0.1,0.1,0.0,0.1,0.5,120.0,4.0"


def key_rows(df):
    return sorted((r.track_id, r.chart, str(r.date), str(r.release_day)) for r in df.collect())


def test_incremental_ingest_matches_batch(spark, tmp_path):
    shards, table, ckpt = tmp_path / "in", tmp_path / "table", tmp_path / "ckpt"
    shards.mkdir()
    shard(shards / "p_1.csv", [row("a", "2017-03-01", "2017"), row("b", "2017-03-02", "0000", "viral50")])
    shard(shards / "p_2.csv", [row("c", "2017-03-03", "2017-02")])
    ingest_chart_shards(spark, str(shards), str(table), str(ckpt)).awaitTermination()
    assert key_rows(read_chart_table(spark, str(table))) == key_rows(typed_charts(read_charts(spark, str(shards))))

    shard(shards / "p_3.csv", [row("d", "2017-03-04", "2017-01-15")])
    shard(shards / "p_4.csv", [row("e", "2017-03-05", "2017-01-16")])
    q = ingest_chart_shards(spark, str(shards), str(table), str(ckpt), max_files_per_trigger=1)
    q.awaitTermination()
    assert q.lastProgress["numInputRows"] == 1  # one shard per micro-batch
    got = key_rows(read_chart_table(spark, str(table)))
    assert got == key_rows(typed_charts(read_charts(spark, str(shards))))
    assert [r[0] for r in got] == ["a", "b", "c", "d", "e"]  # each shard exactly once


def test_runs_with_default_arguments_lose_nothing(spark, tmp_path):
    shards, table = tmp_path / "in", tmp_path / "table"
    shards.mkdir()
    for n, track in enumerate("abc"):
        shard(shards / f"p_{n}.csv", [row(track, "2017-03-01", "2017")])
        ingest_chart_shards(spark, str(shards), str(table)).awaitTermination()
        got = [r[0] for r in key_rows(read_chart_table(spark, str(table)))]
        assert got == sorted("abc"[: n + 1])
    ingest_chart_shards(spark, str(shards), str(table)).awaitTermination()
    assert read_chart_table(spark, str(table)).count() == 3


def test_shard_with_another_header_fails(spark, tmp_path):
    shards = tmp_path / "in"
    shards.mkdir()
    shard(shards / "p_1.csv", [row("a", "2017-03-01", "2017")])
    ingest_chart_shards(spark, str(shards), str(tmp_path / "t")).awaitTermination()
    (shards / "p_2.csv").write_text(",".join(reversed(CHART_COLUMNS)) + "\n" + row("b", "2017-03-01", "2017") + "\n")
    with pytest.raises(Exception):
        ingest_chart_shards(spark, str(shards), str(tmp_path / "t")).awaitTermination()


def same_rows(got, want):
    def key(df):
        return sorted(map(str, df.select(*CHART_COLUMNS, "release_day", "_corrupt_record").collect()))

    assert key(got) == key(want)


def test_shards_with_unlike_headers(spark, tmp_path):
    shards, table = tmp_path / "in put", tmp_path / "table"
    shards.mkdir()
    write_csv(shards / "a 1%.csv", CHART_COLUMNS, [LINE, "", LINE | {"track_id": "t2", "title": 'Say "Hi", now'}])
    write_csv(shards / "b.csv", ["other one", *reversed(CHART_COLUMNS), "x"], [LINE | {"track_id": "t3", "x": "1,2"}])
    write_csv(shards / "c.csv", CHART_COLUMNS, [LINE | {"track_id": "t4", "rank": "first"}, "only one field"])
    (shards / "d.csv").write_text("")
    (shards / "e.csv").write_text("\n" + row("lost", "2017-03-01", "2017") + "\n")

    def run(**kw):
        q = ingest_chart_shards(spark, str(shards), str(table), unlike_headers=True, **kw)
        q.awaitTermination()
        return read_chart_table(spark, str(table))

    got = run(max_files_per_trigger=1)
    batch = typed_charts(read_charts(spark, str(shards), unlike_headers=True))
    assert got.count() == 5 and got.where("_corrupt_record is not null").count() == 2
    same_rows(got.where("_corrupt_record is null"), batch.where("_corrupt_record is null"))
    assert got.where("_corrupt_record like '%only one field%'").count() == 1
    write_csv(shards / "f.csv", ["y", *CHART_COLUMNS], [LINE | {"track_id": "t5"}])
    got = run()
    assert sorted(r.track_id for r in got.where("_corrupt_record is null").collect()) == ["t1", "t2", "t3", "t5"]
    assert run().count() == 6  # nothing twice


def test_a_shard_that_lands_after_the_start_is_taken_by_the_next_run(spark, tmp_path, monkeypatch):
    shards, table = tmp_path / "in", tmp_path / "table"
    shards.mkdir()
    write_csv(shards / "a.csv", CHART_COLUMNS, [LINE])
    plain = ingest.headers_of

    def late(spark, path):
        found = plain(spark, path)
        write_csv(shards / "b.csv", list(reversed(CHART_COLUMNS)), [LINE | {"track_id": "t2"}])
        return found

    monkeypatch.setattr(ingest, "headers_of", late)
    with pytest.raises(Exception, match="landed after the start"):
        ingest_chart_shards(spark, str(shards), str(table), unlike_headers=True).awaitTermination()
    monkeypatch.undo()
    ingest_chart_shards(spark, str(shards), str(table), unlike_headers=True).awaitTermination()
    got = read_chart_table(spark, str(table))
    assert sorted(r.track_id for r in got.collect()) == ["t1", "t2"]


def test_unlike_headers_still_need_every_column_and_a_bounded_run(spark, tmp_path):
    shards, table = tmp_path / "in", tmp_path / "table"
    shards.mkdir()
    with pytest.raises(ValueError, match="no chart file"):
        (shards / "a.csv").write_text("\n")
        ingest_chart_shards(spark, str(shards), str(table), unlike_headers=True)
    write_csv(shards / "b.csv", [c for c in CHART_COLUMNS if c != "region"], [LINE])
    with pytest.raises(ValueError, match="region"):
        ingest_chart_shards(spark, str(shards), str(table), unlike_headers=True)
    with pytest.raises(ValueError, match="available_now"):
        ingest_chart_shards(spark, str(shards), str(table), available_now=False, unlike_headers=True)
    with pytest.raises(ValueError, match="multi_line"):
        ingest_chart_shards(spark, str(shards), str(table), multi_line=True, unlike_headers=True)


def test_line_breaks_in_quoted_fields(spark, tmp_path):
    shards, table = tmp_path / "in", tmp_path / "table"
    shards.mkdir()
    write_csv(shards / "a.csv", CHART_COLUMNS, [LINE | {"title": "two\nlines"}, LINE | {"track_id": "t2"}])
    ingest_chart_shards(spark, str(shards), str(table), multi_line=True).awaitTermination()
    got = read_chart_table(spark, str(table))
    assert sorted((r.track_id, r.title, r._corrupt_record) for r in got.collect()) == [
        ("t1", "two\nlines", None),
        ("t2", "Song", None),
    ]

"""Skew check: one key holds a third of all rows; how much does any task get?

Usage: python tools/skew_check.py [sf_dir]

Derives chart rows from the test tables, then sets a third of the rows
(by a hash of the row) to one hot track-region, one hot artist and one hot
title. Runs the streak (Q2), tier spread (Q4) and title spread (Q3) plans
with Spark's event log written to a scratch folder and prints, per stage,
the largest number of shuffle records any single task read. With partial
aggregation before every shuffle, no task should see the hot key's raw
rows.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from chartlens.plans import questions as Q  # noqa: E402
from chartlens.session import BASE_CONF, fresh_path  # noqa: E402
from chartlens.sources import chart_rows, read_chart_table, write_chart_table  # noqa: E402


def stage_stats(log_dir: str):
    """(query, stage id, name, tasks, max shuffle records per task, total) from the event log."""
    tasks: dict[int, list[int]] = {}
    names: dict[int, str] = {}
    query: dict[int, str] = {}
    files = sorted(p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(p))
    for path in files:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    rec = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    tasks.setdefault(ev["Stage ID"], []).append(rec)
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    names[info["Stage ID"]] = info["Stage Name"].split(" at ")[0]
                elif kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description", "")
                    for sid in ev.get("Stage IDs", []):
                        query.setdefault(sid, desc)
    return [
        (query.get(sid, ""), sid, names.get(sid, "?"), len(r), max(r), sum(r))
        for sid, r in sorted(tasks.items())
        if sum(r)
    ]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="chartlens-eventlog-")
    b = SparkSession.builder.master("local[8]").appName("skew-check")
    # coalescing off: keep all 16 hash partitions visible, so a hot key
    # would show as one task far above the others
    for k, v in {**BASE_CONF, "spark.sql.shuffle.partitions": "16", "spark.eventLog.enabled": "true",
                 "spark.sql.adaptive.coalescePartitions.enabled": "false",
                 "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
                 "spark.ui.showConsoleProgress": "false"}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    hot = (F.abs(F.hash("track_id", "region", "date", "rank", "title")) % 3) == 0
    rows = chart_rows(spark, sf_dir).withColumns(
        {
            "track_id": F.when(hot, F.lit("HOT")).otherwise(F.col("track_id")),
            "region": F.when(hot, F.lit("NATION_0")).otherwise(F.col("region")),
            "artist": F.when(hot, F.lit("HOT ARTIST")).otherwise(F.col("artist")),
            "title": F.when(hot, F.lit("HOT TITLE")).otherwise(F.col("title")),
        }
    )
    path = fresh_path(spark, "skew-charts")
    write_chart_table(rows, path)
    charts = read_chart_table(spark, path)
    total = charts.count()
    hot_rows = charts.where(F.col("track_id") == "HOT").count()
    print(f"rows={total} hot track-region rows={hot_rows} ({hot_rows / total:.0%})")
    for name, df in [("q2_streak", Q.q2_streak(charts)), ("q4_spread", Q.q4_spread(charts)),
                     ("q3_title", Q.q3_corridors(charts))]:
        spark.sparkContext.setJobDescription(name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()
    print("query       stage  tasks  max_records_per_task  mean_per_task  total_records")
    for q, sid, _, n, mx, tot in stage_stats(log_dir):
        print(f"{q:10s}  {sid:5d}  {n:5d}  {mx:20d}  {tot / n:13.0f}  {tot:13d}")
    print(f"event log: {log_dir}")


if __name__ == "__main__":
    main()

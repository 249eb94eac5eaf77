"""Scaling check: time the headline questions on k times the sf0.1 chart rows.

Usage: python tools/scale_check.py [k] [sf_dir]

The chart rows derived from the test tables are repeated k times with the
copy number appended to track, title and artist keys, so the number of
tracks, titles and artists grows k times (a bigger catalogue, not
duplicate rows). Each question runs once warm at 1x and at kx; the ratio
of times shows how close to linear the plans scale on one machine.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from chartlens.operators import genres  # noqa: E402
from chartlens.plans import questions as Q  # noqa: E402
from chartlens.session import fresh_path, local_session  # noqa: E402
from chartlens.sources import chart_rows, read_chart_table, write_chart_table  # noqa: E402

QUESTIONS = {
    "q1": lambda c: Q.q1_delay(c),
    "q2": lambda c: Q.q2_streak(c),
    "q3": lambda c: Q.q3_corridors(c),
    "q4": lambda c: Q.q4_spread(c),
    "q6_best": lambda c: Q.q6_best_genre(c, "long_date"),
    "q6_pivot": lambda c: genres.genre_pivot(Q.genre_rows(c, "long_date")),
}


def copies(df, k: int):
    """k copies of the rows with the copy number appended to the keys."""
    if k == 1:
        return df
    rep = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    suffix = F.concat(F.lit("#"), F.col("_copy").cast("string"))
    return rep.withColumns(
        {
            "track_id": F.concat("track_id", suffix),
            "title": F.concat("title", suffix),
            "artist": F.concat("artist", suffix),
        }
    ).drop("_copy")


def timed(fn, charts) -> float:
    """Build the plan (some questions write an intermediate table while
    building) and run it to completion; both are timed."""
    t = time.perf_counter()
    fn(charts).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    k = int(sys.argv[1]) if len(sys.argv) > 1 else 10
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=16)
    out = {"k": k}
    for factor in (1, k):
        path = fresh_path(spark, f"scale-x{factor}")
        write_chart_table(copies(chart_rows(spark, sf_dir), factor), path)
        charts = read_chart_table(spark, path)
        rows = charts.count()
        times = {}
        for name, fn in QUESTIONS.items():
            timed(fn, charts)  # warm-up
            times[name] = round(min(timed(fn, charts) for _ in range(2)), 3)
        out[f"x{factor}"] = {"rows": rows, "sec": times, "total": round(sum(times.values()), 3)}
    out["ratio"] = round(out[f"x{k}"]["total"] / out["x1"]["total"], 2)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

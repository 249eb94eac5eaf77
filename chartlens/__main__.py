"""Command line: ingest chart files and write question reports.

    python -m chartlens ingest  --input 'charts/p_*.csv' --table charts_typed
    python -m chartlens reports --table charts_typed --out reports [--questions delay_streak tiers ...]
    python -m chartlens reports --input 'charts/p_*.csv' --out reports

Run under ``spark-submit`` on a cluster (the session and its settings come
from there), or add ``--local`` for a local session.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from chartlens.plans.reports import QUESTIONS, write_reports
from chartlens.session import BASE_CONF, local_session
from chartlens.sources import read_chart_table, read_charts, typed_charts, write_chart_table

RUNTIME_SQL_CONF = {k: v for k, v in BASE_CONF.items() if k.startswith("spark.sql.")}


def _session(local: bool) -> SparkSession:
    if local:
        return local_session()
    spark = SparkSession.builder.appName("chartlens").getOrCreate()
    for k, v in RUNTIME_SQL_CONF.items():
        spark.conf.set(k, v)
    return spark


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="chartlens")
    p.add_argument("--local", action="store_true", help="use a local session")
    sub = p.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest", help="read chart files and write the typed chart table")
    ing.add_argument("--input", required=True, nargs="+")
    ing.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ing.add_argument("--table", required=True)
    ing.add_argument("--unlike-headers", action="store_true", help="CSV files may have columns in different orders")
    rep = sub.add_parser("reports", help="write question reports from the typed chart table or raw files")
    src = rep.add_mutually_exclusive_group(required=True)
    src.add_argument("--table", help="typed chart table written by `ingest`")
    src.add_argument("--input", nargs="+", help="raw chart files (CSV), typed on the fly")
    rep.add_argument("--out", required=True)
    rep.add_argument("--questions", nargs="+", default=list(QUESTIONS), choices=list(QUESTIONS))
    rep.add_argument("--genre-date", default="date")
    rep.add_argument("--format", default="csv", choices=["csv", "parquet"])
    args = p.parse_args(argv)

    spark = _session(args.local)
    if args.cmd == "ingest":
        src = args.input if len(args.input) > 1 else args.input[0]
        write_chart_table(read_charts(spark, src, args.format, unlike_headers=args.unlike_headers), args.table)
    else:
        if args.table:
            charts = read_chart_table(spark, args.table)
        else:
            charts = typed_charts(read_charts(spark, args.input if len(args.input) > 1 else args.input[0]))
        for path in write_reports(charts, args.out, args.questions, args.genre_date, args.format):
            print(path)


if __name__ == "__main__":
    main()

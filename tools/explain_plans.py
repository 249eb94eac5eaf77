"""Print physical plans of the headline questions over a parquet chart table.

Usage: python tools/explain_plans.py [name ...] [--full] [--write docs/PLANS.md]

For each plan: number of shuffles (Exchange), broadcasts, operators inside
whole-stage code generation (and the kinds outside it), scans with their
pushed filters and read schema. ``--full`` prints the formatted plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chartlens.plans import questions as Q  # noqa: E402
from chartlens.session import fresh_path, local_session  # noqa: E402
from chartlens.sources import chart_rows, read_chart_table, write_chart_table  # noqa: E402

PLANS = {
    "q1": lambda c: Q.q1_delay(c),
    "q2": lambda c: Q.q2_streak(c),
    "q3": lambda c: Q.q3_corridors(c),
    "q4_spread": lambda c: Q.q4_spread(c),
    "q4_corridors": lambda c: Q.q4_corridors(c),
    "q5_frame": lambda c: Q.model_data(c),
    "q6_best": lambda c: Q.q6_best_genre(c),
    "q6_quart": lambda c: Q.q6_quartiles(c),
}


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    full = "--full" in sys.argv
    write_to = sys.argv[sys.argv.index("--write") + 1] if "--write" in sys.argv else None
    if write_to:
        args = [a for a in args if a != write_to]
    doc = ["# Physical plans of the headline questions", "",
           "Generated by `python tools/explain_plans.py --write docs/PLANS.md` on the typed chart table of",
           "sf0.1 (local session, AQE on, broadcast joins off as for tables too large for them). Each block is the final adaptive plan after the query ran;",
           "`*(n)` marks operators inside whole-stage code generation.", ""]
    spark = local_session()
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # full filter lists
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    path = fresh_path(spark, "explain-charts")
    write_chart_table(chart_rows(spark, "/root/testdata/sf0.1"), path)
    charts = read_chart_table(spark, path)
    for name, fn in PLANS.items():
        if args and name not in args:
            continue
        df = fn(charts)
        plan = df._jdf.queryExecution().executedPlan().toString()
        text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted") if full else plan
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
        bcast = plan.count("BroadcastExchange")
        # code generation is decided when the adaptive plan runs: run the
        # query, then read the final plan
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        skip = ("Exchange", "BroadcastExchange", "AdaptiveSparkPlan", "==", "ResultQueryStage", "ShuffleQueryStage",
                "BroadcastQueryStage", "AQEShuffleRead", "ReusedExchange", "TableCacheQueryStage")
        ops = [ln.strip().lstrip(":+- ") for ln in final.splitlines()]
        ops = [o for o in ops if o and not o.startswith(skip)]
        in_codegen = sum(1 for o in ops if re.match(r"\*\(\d+\)", o))
        outside = sorted({o.split(" ")[0].split("[")[0] for o in ops if not re.match(r"\*\(\d+\)", o)})
        print(f"== {name}: shuffles={shuffles} broadcasts={bcast} "
              f"codegen={in_codegen}/{len(ops)} operators; outside codegen: {', '.join(outside)}")
        for m in re.finditer(r"PushedFilters: (\[[^\]]*\])", plan):
            print("   pushed", m.group(1))
        for m in re.finditer(r"ReadSchema: (struct<[^>]*>)", plan):
            print("   read  ", m.group(1))
        if full:
            print(text)
        if write_to:
            tree = re.sub(r"Location: InMemoryFileIndex\([^\]]*\]", "Location: <table>", final)
            tree = re.sub(r", \[plan_id=\d+\]", "", tree)
            doc += [f"## {name}", "", f"shuffles={shuffles} broadcasts={bcast} "
                    f"codegen={in_codegen}/{len(ops)} operators; outside codegen: {', '.join(outside)}", "",
                    "```", tree.rstrip().removesuffix("+-").rstrip(), "```", ""]
    if write_to:
        os.makedirs(os.path.dirname(write_to) or ".", exist_ok=True)
        with open(write_to, "w") as fh:
            fh.write("\n".join(doc))
    spark.stop()


if __name__ == "__main__":
    main()

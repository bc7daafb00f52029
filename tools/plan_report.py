"""Plan shape of every registered batch query (final adaptive plan).

Usage: python tools/plan_report.py [--sf DIR] > PLANS.md

Runs each query once, then counts the physical operators of the plan AQE
actually executed: scans, shuffles, broadcasts, joins, windows, aggregates and
any Python evaluation. Streaming queries are skipped (their work happens in
several jobs before the returned frame is read).
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

OPERATORS = [
    ("scans", "FileScan parquet"),
    ("shuffles", "Exchange hashpartitioning"),
    ("range shuffles", "Exchange rangepartitioning"),
    ("single-partition", "Exchange SinglePartition"),
    ("reused", "ReusedExchange"),
    ("broadcasts", "BroadcastExchange"),
    ("BHJ", "BroadcastHashJoin"),
    ("SMJ", "SortMergeJoin"),
    ("windows", "Window ["),
    ("hash agg", "HashAggregate("),
    ("sort agg", "SortAggregate("),
    ("python", "EvalPython"),
]
STREAMING = {"ingest_stream", "quarantine_stream", "scd1_stream", "scd2_stream", "scd2_stream_out_of_order",
             "run_log_stream_totals", "gold_stream", "refresh_marts"}


def final_plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args()

    from paylake.session import build_session

    spark = build_session("local[8]", 8)
    from paylake.registry import QUERIES

    print(f"# Plan shapes (final adaptive plans, {os.path.basename(args.sf)}, local[8])\n")
    print("Generated by `python tools/plan_report.py`. Counts of physical operators in the plan AQE executed; "
          "`BHJ` = broadcast hash join, `SMJ` = sort-merge join. Mart queries read the stored silver/gold "
          "tables; silver and gold queries compute from the landed feeds.\n")
    print("| query | " + " | ".join(n for n, _ in OPERATORS) + " |")
    print("| --- | " + " | ".join("---" for _ in OPERATORS) + " |")
    for name, fn in QUERIES.items():
        if name in STREAMING or any(part in name for part in ("stream", "incremental", "changes")):
            continue
        df = fn(spark, args.sf)
        df.collect()
        plan = final_plan(df)
        counts = [str(plan.count(pat)) for _, pat in OPERATORS]
        print(f"| `{name}` | " + " | ".join(counts) + " |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

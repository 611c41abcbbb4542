"""Physical-plan summary of every registered query (AQE final plans).

    python tests/plan_report.py [--sf DIR] > PLANS.md

Counts shuffles, broadcasts, join strategies, windows (and pre-shuffle
WindowGroupLimits), aggregates and scans in the executed plan, and checks that
every Parquet scan reads a pruned schema.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

NODES = [
    ("shuffles", r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)"),
    ("broadcasts", r"BroadcastExchange"),
    ("reused", r"ReusedExchange"),
    ("smj", r"SortMergeJoin"),
    ("bhj", r"BroadcastHashJoin"),
    ("windows", r"\bWindow \["),
    ("group_limit", r"WindowGroupLimit"),
    ("hash_agg", r"HashAggregate"),
    ("sort_agg", r"SortAggregate"),
    ("scans", r"FileScan parquet"),
    ("ckpt_scans", r"Scan ExistingRDD|LogicalRDD|ExistingRDD"),
]


def final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()          # execute this very plan (no rows to the driver) so AQE finalises it
    text = qe.executedPlan().toString()
    assert "AdaptiveSparkPlan" not in text or "isFinalPlan=true" in text
    return text.split("== Initial Plan ==")[0]


def main(argv=None):
    p = argparse.ArgumentParser()
    p.add_argument("--sf", default="/root/testdata/sf0.01")
    p.add_argument("names", nargs="*")
    a = p.parse_args(argv)
    from subledger.plans.registry import QUERIES
    from subledger.session import get_session
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.maxPlanStringLength", str(2 ** 30))
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    names = a.names or list(QUERIES)
    print(f"# Executed plans of the registered queries ({os.path.basename(a.sf)}, AQE final plans)\n")
    print("Columns count operators in the final physical plan; intermediates checkpointed by the "
          "query show up as `stored <model>` scans. `columns read` lists, per scanned table, the columns in "
          "the Parquet ReadSchema out of the table's columns.\n")
    print("| query | " + " | ".join(n for n, _ in NODES) + " | columns read | scans with pushed filters |")
    print("|---|" + "---|" * (len(NODES) + 2))
    import pyarrow.parquet as pq
    width = {}
    for name in names:
        plan = final_plan(QUERIES[name][0](spark, a.sf))
        counts = [len(re.findall(rx, plan)) for _, rx in NODES]
        widths, pushed = [], 0
        for line in plan.splitlines():
            if "FileScan parquet" not in line:
                continue
            loc = re.search(r"Location: [^\[]*\[file:([^\],]+)", line)
            schema = re.search(r"ReadSchema: struct<(.*)>", line)
            filters = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            pushed += bool(filters and filters.group(1).strip())
            path = loc.group(1) if loc else "?"
            if "/models/" in path:
                table = "stored " + path.split("/models/")[1].split("-")[0]
                widths.append(table)
                continue
            if path not in width:
                width[path] = len(pq.read_schema(path).names)
            table = os.path.basename(path).replace(".parquet", "")
            n = schema.group(1).count(":") if schema else "?"
            widths.append(f"{table} {n}/{width[path]}")
        read = ", ".join(sorted(set(widths))) or "-"
        print(f"| {name} | " + " | ".join(str(c) for c in counts) + f" | {read} | {pushed} |",
              flush=True)


if __name__ == "__main__":
    main()

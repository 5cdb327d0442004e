"""Write docs/PLANS.md: the shape of every batch query's physical plan.

Usage: python tools/dump_plans.py [sf_dir]
Keeps the operators that decide cost at scale - exchanges, joins,
aggregations, windows, expands/generates and scans (with pushed filters
and read schema) - so plan regressions are visible in review.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickforge.plans import catalog  # noqa: E402
from tickforge.session import build_session  # noqa: E402

KEEP = ("Exchange", "Join", "Aggregate", "Window", "Expand", "Generate", "Scan", "Union",
        "BroadcastExchange", "Sort ")


def shape(plan: str) -> list[str]:
    out = []
    for line in plan.split("\n"):
        if any(k in line for k in KEEP):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r", \[plan_id=\d+\]", "", line)
            line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\], ", "", line)
            out.append(line[:220])
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    lines = ["# Physical plan shapes", "",
             f"Generated by `tools/dump_plans.py` on `{sf_dir}` (initial plans, before AQE "
             "re-optimisation; a broadcast here is Spark's size estimate). "
             "Streaming and incremental queries reuse these operators.", ""]
    for name, fn in catalog.QUERIES.items():
        if name.startswith(("stream_", "incremental_")):
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        lines += [f"## {name}", "", "```"] + shape(plan) + ["```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                        "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()

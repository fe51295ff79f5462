"""Summarise the physical plan of every catalogue query (for PLANS.md).

For each query: scanned tables with the number of columns read, hash / range /
single-partition shuffles, broadcasts, join and aggregate strategies, taken
from the plan Spark would execute (before AQE re-optimisation).  Prints a
Markdown table.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kempt.plans.catalogue import QUERIES as CORE  # noqa: E402
from kempt.session import local_session  # noqa: E402

PATTERNS = {
    "hash shuffles": r"Exchange hashpartitioning",
    "single-partition": r"Exchange SinglePartition",
    "range shuffles": r"Exchange rangepartitioning",
    "broadcasts": r"BroadcastExchange",
    "BHJ": r"BroadcastHashJoin",
    "SMJ": r"SortMergeJoin",
    "hash agg": r"HashAggregate\(",
    "sort agg": r"SortAggregate\(",
}


def summarise(plan: str) -> dict:
    out = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/(\w+)\.parquet",
                       plan)
    out["scans"] = ", ".join(f"{t}({len(cols.split(','))})" for cols, t in scans)
    return out


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), shuffle_partitions=16, app="kempt-plans")
    spark.sparkContext.setLogLevel("ERROR")
    cols = ["scans"] + list(PATTERNS)
    print("| query | " + " | ".join(cols) + " |")
    print("|---" * (len(cols) + 1) + "|")
    for name, build in sorted(CORE.items()):
        plan = build(spark, sf)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)


if __name__ == "__main__":
    main()

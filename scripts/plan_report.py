"""Summarise the physical plan of every registered query, as it ran (writes PLANS.md).

Two settings per query: the session default (small sides broadcast by size)
and ``autoBroadcastJoinThreshold=-1``, which is what the plans look like when
the inputs are too big to broadcast (no plan has a broadcast hint).

Usage: python scripts/plan_report.py [--sf-dir DIR] [--out PLANS.md]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNTS = {
    "hash shuffles": r"Exchange hashpartitioning",
    "range shuffles": r"Exchange rangepartitioning",
    "broadcasts": r"BroadcastExchange",
    "SMJ": r"SortMergeJoin",
    "BHJ": r"BroadcastHashJoin",
    "partial aggs": r"HashAggregate\(keys=.*functions=\[partial_",
    "window limits": r"WindowGroupLimit",
    "file scans": r"FileScan parquet",
}


def summary(plan: str) -> dict[str, int]:
    out = {k: len(re.findall(p, plan)) for k, p in COUNTS.items()}
    out["pushed filters"] = len(re.findall(r"PushedFilters: \[[^\]\s]", plan))  # long lists are cut off
    return out


def executed(df) -> str:
    """The plan that ran, each part that is used again once."""
    df._jdf.queryExecution().toRdd().count()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return "\n".join(line for line in plan.split("\n") if "ReusedExchange" not in line)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                                  "PLANS.md"))
    args = ap.parse_args(argv)
    from tessera.plans.catalog import QUERIES
    from tessera.session import local_session
    spark = local_session(8, 16)
    rows = []
    for name in QUERIES:
        per = []
        for threshold in (None, "-1"):
            if threshold:
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            else:
                spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            per.append(summary(executed(QUERIES[name](spark, args.sf_dir))))
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        rows.append((name, per))
    cols = list(COUNTS) + ["pushed filters"]
    lines = ["# Physical plans", "",
             f"Node counts of each registered query's physical plan at `{args.sf_dir}` as it ran (a part used again counts once),",
             "generated by `scripts/plan_report.py`. Each cell is `default / no auto-broadcast`: the second",
             "number shows the plan when no side is small enough to broadcast by Spark's own estimate, which is",
             "the situation at cluster scale (no broadcast is forced by a hint).",
             "Pushed filters are those that Spark lists; on time columns without a zone it doesn't skip row groups",
             "of these files by them (see README, period snapshots).",
             "Queries over stored snapshots read their table (`Bucketed: true`), which the first of them writes.",
             "No plan contains a cross product or a Python evaluation node; one has a sort-based aggregate, the",
             "unique comparison, which takes the least of text columns within buckets",
             "(`tests/test_queries.py` checks this).", "",
             "| query | " + " | ".join(cols) + " |", "| --- |" + " --- |" * len(cols)]
    for name, (a, b) in rows:
        lines.append(f"| `{name}` | " + " | ".join(f"{a[c]} / {b[c]}" for c in cols) + " |")
    with open(args.out, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    print(f"wrote {args.out}")


if __name__ == "__main__":
    main()

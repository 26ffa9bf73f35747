"""Physical-plan summary of every registered query -> PLANS.md.

For each query: shuffle exchanges (and their partitioning keys), broadcast
exchanges, single-partition exchanges, Python evaluation nodes and the read
schema of every scan. Static plans (AQE may still coalesce or switch joins
at run time). Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroupsInPandas",
            "PythonMapInArrow", "FlatMapGroupsInArrow")


def summarize(plan: str) -> dict:
    shuffles = re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning)\(([^)]*)\)",
                          plan)
    keys = [re.sub(r"#\d+L?", "", k).rsplit(",", 1)[0] for _, k in shuffles]
    scans = re.findall(r"FileScan (\w+) .*?ReadSchema: (struct<[^\n]*?>)(?:\n|$)", plan)
    return {
        "shuffles": len(shuffles),
        "keys": keys,
        "broadcasts": plan.count("BroadcastExchange"),
        "single": plan.count("Exchange SinglePartition"),
        "python": sorted({n for n in PY_NODES if n in plan}),
        "scans": [(fmt, re.sub(r"struct<(.*)>", r"\1", rs)[:90]) for fmt, rs in scans],
        "codegen_stages": len(set(re.findall(r"\*\((\d+)\)", plan))),
    }


def main() -> None:
    from tessera.plans.queries import QUERIES
    from tessera.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan
    skip = {"rf_pipeline", "forest_checked"}  # fit a model while being built; the plan is the forest's predict
    print("# Physical plans of the registered queries\n")
    print("Generated by `tools/plan_report.py` (static plans, AQE off; at run time AQE may coalesce")
    print("partitions or turn a shuffle join into a broadcast). `shuffles` counts hash/range exchanges;")
    print("`single` counts exchanges to one partition; `python` lists Python evaluation nodes.\n")
    print("| query | shuffles (keys) | broadcasts | single | python | codegen stages | scans (ReadSchema) |")
    print("|---|---|---|---|---|---|---|")
    for name, q in QUERIES.items():
        if name in skip:
            continue
        plan = q(spark, sf)._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        keys = "; ".join(s["keys"]) if s["keys"] else ""
        scans = "<br>".join(f"{f}: {r}" for f, r in s["scans"])
        print(f"| `{name}` | {s['shuffles']} ({keys}) | {s['broadcasts']} | {s['single']} | "
              f"{', '.join(s['python'])} | {s['codegen_stages']} | {scans} |")
    spark.stop()


if __name__ == "__main__":
    main()

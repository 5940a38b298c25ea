"""Plan shape of every contest query (static plan, AQE off, no broadcast
thresholds -- i.e. the plan a large cluster would start from).

    python plan_report.py [/root/testdata/sf0.01] > PLANS.md
"""

from __future__ import annotations

import re
import sys


def shape(plan: str) -> dict:
    ex = re.findall(r"Exchange (\w+)", plan)
    return {
        "scans": len(re.findall(r"(?:FileScan|Scan) parquet", plan)),
        "hash_ex": sum(e == "hashpartitioning" for e in ex),
        "single_ex": sum(e == "SinglePartition" for e in ex),
        "range_ex": sum(e == "rangepartitioning" for e in ex),
        "broadcast": plan.count("BroadcastExchange"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "partial_topk": plan.count("WindowGroupLimit"),
        "codegen": len(set(re.findall(r"\*\((\d+)\)", plan))),
        "python": int(any(k in plan for k in ("EvalPython", "PythonUDF", "InPandas"))),
    }


def main() -> None:
    sys.path.insert(0, ".")
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from duelframe.session import build_session
    spark = build_session("local[4]", app="plan-report", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    from duelframe.plans.catalog import QUERIES
    from duelframe.sources.fixtures import bouts
    frames = {name: fn(spark, sf) for name, fn in QUERIES.items()}  # builds memoised facts
    # plans are made on first access, so these settings apply to all frames
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    cols = ["scans", "hash_ex", "single_ex", "range_ex", "broadcast", "windows", "partial_topk",
            "codegen", "python"]
    print("# Plan shapes\n")
    print("Static physical plans (AQE off, automatic broadcast off) over the raw contest")
    print("table; `single_ex` only ever sits above a top-k or an aggregate with small keys")
    print("(`tests/test_plans.py`).  Generated by `plan_report.py`.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    fx = shape(bouts(spark, sf)._jdf.queryExecution().executedPlan().toString())
    print("| (fixture) bouts | " + " | ".join(str(fx[c]) for c in cols) + " |")
    for name, df in frames.items():
        s = shape(df._jdf.queryExecution().executedPlan().toString())
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()

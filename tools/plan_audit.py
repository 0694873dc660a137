"""Physical-plan audit of the registered queries.

For every query: shuffles by kind, broadcasts, nested-loop/cartesian joins,
Python evaluation nodes, and what reaches each Parquet scan.  Prints a
markdown table.  Queries whose result is model metadata (built on the driver
from a fitted model) are listed without a plan.

usage: python tools/plan_audit.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabula.plans import registry  # noqa: E402
from tabula.session import get_spark  # noqa: E402

# their rows are model metadata or metrics of a search: no plan over the table is left
SKIP = ("l1_l11", "l2_l11", "l2_rf", "l3_log", "l4_lin", "l5_dec", "l6_rf", "l10_", "l12_", "l13_", "l14_")


def audit(plan: str) -> dict:
    return {
        "hash": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single": len(re.findall(r"Exchange SinglePartition", plan)),
        "bcast": plan.count("BroadcastExchange"),
        "nlj/cartesian": plan.count("BroadcastNestedLoopJoin") + plan.count("CartesianProduct"),
        "python": plan.count("BatchEvalPython") + plan.count("ArrowEvalPython"),
        "scans": plan.count("FileScan"),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]\s]", plan)),
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    print("| query | hash shuffles | range shuffles | to one partition | broadcasts | nested-loop/cartesian "
          "| python nodes | scans | scans with pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in registry.QUERIES.items():
        if name.startswith(SKIP):
            print(f"| {name} | model fit (Spark ML jobs) | | | | | | | |")
            continue
        spark.catalog.clearCache()
        df = fn(spark, sf_dir)
        a = audit(df._jdf.queryExecution().executedPlan().toString())
        print(f"| {name} | " + " | ".join(str(v) for v in a.values()) + " |")
    spark.stop()


if __name__ == "__main__":
    main()

"""Headline timings: prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is forced to completion with the ``noop`` sink (full evaluation,
nothing collected to the driver).  Each query runs once, in list order, after
one small warm-up scan: the model queries include Spark ML's first-use JVM
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabula.plans import jobs, registry  # noqa: E402
from tabula.session import get_spark, ship_library  # noqa: E402

HEADLINE = [
    "a6_sums_total_order_desc",
    "a9_describe",
    "a14_corr_matrix",
    "a16_cardinality",
    "c5_null_report",
    "d1_line_data",
    "m3_hash_split_75_25_composite_key",
    "m4_stratified_sample",
    "f2_string_index_many",
    "f5_standard_scale",
    "e1_regression_metrics",
    "e4_auc_exact_score",
    "e5_confusion",
    "e7_multiclass_metrics",
    "l2_rf_regressor_demand",
    "l1_l11_claims_linear_cv",
    "l5_decision_tree_churn",
    "forest_search_12_points",
]

#: A forest search that ends soon: 12 grid points (the registered whole one has 75), for seconds a fit.
SMALL_GRID = {"maxDepth": [2, 5, 10], "maxBins": [20, 40], "numTrees": [10, 30]}
OWN = {"forest_search_12_points": lambda spark, sf_dir: jobs.churn_classification(spark, sf_dir, "rf_cls", frame="orders", params=SMALL_GRID)}

# Models fitted by a search, 3 folds and the refit: one a grid point and fold, for trees one a fold
# and number of bins (all five remain, as prices have more values than any and priorities fewer).
FITS = {"l1_l11_claims_linear_cv": 49, "l5_decision_tree_churn": 16, "forest_search_12_points": 7}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", app="tabula-bench", shuffle_partitions=max(8, cpus * 2),
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    ship_library(spark)
    # warm-up: JVM class loading and parquet footers, not timed
    spark.read.parquet(f"{sf_dir}/region.parquet").count()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        df = (OWN.get(name) or registry.QUERIES[name])(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        spark.catalog.clearCache()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf,
                      "seconds_per_fit": {n: round(times[n] / k, 3) for n, k in FITS.items()}}))
    spark.stop()


if __name__ == "__main__":
    main()

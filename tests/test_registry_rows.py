"""Registered queries without a SQL oracle: each runs on the smallest tables and
keeps its invariants (the driver's rows-only check, made stricter)."""

import math

import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry
from tabula.plans import registry

OWN = set(registry.QUERIES)  # optional queries have tests of their own
ROWS_ONLY = sorted(OWN - set(entry.oracle_sql()))


def test_rows_only_list_is_small_and_known():
    assert all(n.startswith(("s9_", "s11_", "m1_", "l")) for n in ROWS_ONLY), ROWS_ONLY


#: Whole searches and the workload's large forest.
SLOW = {"l1_l11_claims_linear_cv", "l2_l11_claims_rf_cv", "l2_rf_regressor_demand", "l3_logistic_churn", "l4_linear_svc_churn", "l5_decision_tree_churn", "l5_tree_churn_by_hard_decision",
        "l6_rf_classifier_churn", "l10_l12_grid_search_table", "l12_best_params", "l13_feature_importances"}


@pytest.mark.parametrize("name", [pytest.param(n, marks=pytest.mark.slow) if n in SLOW else n for n in ROWS_ONLY])
def test_rows_only_query_invariants(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    if name.startswith("s9_"):
        import os
        sizes = {f: os.path.getsize(f"{SF_SMALL}/{f}") for f in os.listdir(SF_SMALL)}
        assert len(rows) == 14 and {os.path.basename(r.path): r.length for r in rows} == sizes
    elif name.startswith("s11_"):
        assert rows and all(r.same for r in rows)
    elif name.startswith("m1_"):
        n = spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
        assert 0 < len(rows) < n
    elif name == "l13_feature_importances":
        assert math.isclose(sum(r.importance for r in rows), 1.0, rel_tol=1e-9)
        assert [r.slot for r in rows] == list(range(len(rows)))
    elif name == "l10_l12_grid_search_table":
        assert sum(r.is_best for r in rows) == 1
    elif name == "l12_best_params":
        assert {r.param for r in rows} >= {"regParam", "elasticNetParam", "fitIntercept"}
    elif name == "l7_l9_pipeline_fit_score":
        assert rows and {r.prediction for r in rows} <= {0.0, 1.0}
    elif name == "l14_leaderboard":
        assert set(df.columns) == {"run", "model", "metric", "value", "rank"} and len(rows) == 4 * 6
        assert all(sorted(r["rank"] for r in rows if r.metric == m) == [1, 2, 3, 4] for m in {r.metric for r in rows})
    else:  # long-form metrics
        assert rows and set(df.columns) == {"run", "model", "metric", "value"}
        assert all(r.value is None or math.isfinite(r.value) for r in rows)

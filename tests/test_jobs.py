"""End-to-end workloads on the smallest tables: shape and sanity invariants."""

import math

from conftest import SF_SMALL
from tabula.plans import jobs


def _metrics(df):
    return {(r.model, r.metric): r.value for r in df.collect()}


def test_demand_regression(spark):
    m = _metrics(jobs.demand_regression(spark, SF_SMALL, trees=3, depth=3))
    vals = {k[1]: v for k, v in m.items()}
    assert set(vals) == {"rows", "rmse", "mse", "mae", "r2"}
    assert vals["rows"] > 0 and math.isclose(vals["rmse"] ** 2, vals["mse"], rel_tol=1e-9)


def test_claims_regression_linear(spark):
    m = _metrics(jobs.claims_regression(spark, SF_SMALL, params={"regParam": [0.1]}))
    vals = {k[1]: v for k, v in m.items()}
    assert vals["rows"] > 0 and vals["r2"] <= 1.0


def test_churn_classification(spark):
    m = _metrics(jobs.churn_classification(spark, SF_SMALL, "tree", frame="orders",
                                           params={"maxDepth": [2]}))
    vals = {k[1]: v for k, v in m.items()}
    assert vals["total"] == vals["correct"] + vals["wrong"]
    assert math.isclose(vals["ratio_correct"] + vals["ratio_wrong"], 1.0)
    assert 0.0 <= vals["auc_score"] <= 1.0
    assert 0.0 <= vals["auc_pr"] <= 1.0


def test_demand_maps_missing_weather_to_the_default(spark):
    from pyspark.sql import functions as F
    from tabula.functions.codes import WEATHER_CODES, WEATHER_DEFAULT
    from tabula.operators.columns import map_codes
    from tabula.plans import standins
    df = map_codes(standins.bike_frame(spark, SF_SMALL), "weathersit", WEATHER_CODES, WEATHER_DEFAULT, out="w")
    assert {r.w for r in df.filter(F.col("weathersit").isNull()).select("w").distinct().collect()} == {WEATHER_DEFAULT}
    assert "weather_label" in standins.BIKE_LABEL_ROLES.categorical


def test_jobs_store_metrics_and_parameters(spark, tmp_dir):
    from tabula.sources import sinks
    jobs.claims_regression(spark, SF_SMALL, params={"regParam": [0.1]}, path=tmp_dir)
    stored = {r.metric: r.value for r in sinks.read_metrics(spark, tmp_dir).collect()}
    assert stored["param_regParam"] == 0.1 and {"rmse", "r2"} <= set(stored)


def test_leaderboard_ranks_errors_upwards(spark):
    from tabula.operators import sampling
    from tabula.plans import models, standins
    df = standins.churn_orders_frame(spark, SF_SMALL)
    train, test = sampling.hash_split(df, "o_orderkey", [0.8, 0.2], seed=42)
    fitted = {}
    for kind, params in (("tree", {"maxDepth": 4}), ("logistic", {"maxIter": 10})):
        est = models.estimator(kind, **params)
        fitted[kind] = models.fit(models.build_pipeline(standins.CHURN_ORDERS_ROLES, est, encode="index", label_source="churn"), train)
    table = jobs.leaderboard(fitted, test).collect()
    best = {r.metric: r.model for r in table if r["rank"] == 1}
    value = {(r.model, r.metric): r.value for r in table}
    assert set(best) == {"accuracy", "error_rate", "auc_hard", "auc_swapped", "auc_score", "auc_pr"}
    assert best["accuracy"] == best["error_rate"]
    assert value[(best["error_rate"], "error_rate")] == min(value[(m, "error_rate")] for m in fitted)
    from tabula.operators.evaluate import exact_curve_areas, score_of
    for name, model in fitted.items():
        assert math.isclose(exact_curve_areas(model.transform(test), "label", score_of("rawPrediction")).first().auc, value[(name, "auc_score")])

"""One deep fit answers a grid: against separate fits of every grid point."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tabula.operators import evaluate, sampling
from tabula.plans import forest_search, models, standins

ONE = {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all"}


def _frame(spark):
    df = standins.churn_orders_frame(spark, SF_SMALL).withColumn("y", F.col("totalprice") / 1000 + F.length("o_orderpriority"))
    df = df.withColumn("churn", F.when(F.xxhash64("o_orderkey") % 3 == 0, "False").otherwise(F.col("churn")))
    return sampling.with_folds(df, "o_orderkey", 2, seed=7)


def _both(spark, kind, space, column=None, metric=None, **fixed):
    df = models.laid_out(_frame(spark), "o_orderkey").persist()
    reg = kind == "rf_reg"
    est = models.estimator(kind, label="y" if reg else "label", **fixed)
    roles = standins.CHURN_ORDERS_ROLES
    pipe = models.build_pipeline(roles, est, encode="index", label_source=None if reg else "churn")
    maps, ev = models.grid(est, space), models.evaluator(kind, label=est.getLabelCol(), metric=metric, column=column)
    assert forest_search.applies(pipe, maps, ev)
    out = [f(pipe, maps, ev, df, "fold", 2, 3) for f in (forest_search.search, models._fold_metrics)]
    df.unpersist()
    return out


@pytest.mark.slow
@pytest.mark.parametrize("kind,column,fixed", [("rf_reg", None, ONE), ("tree", None, {}), ("tree", "prediction", {}), ("rf_cls", None, ONE), ("rf_cls", "prediction", ONE)])
def test_single_trees_equal_separate_fits(spark, kind, column, fixed):
    nested, apart = _both(spark, kind, {"maxDepth": [1, 3, 9], "maxBins": [8, 90]}, column, **fixed)
    assert nested.shape == (2, 6)
    np.testing.assert_allclose(nested, apart, rtol=1e-9)


@pytest.mark.parametrize("metric", ["mse", "mae", "r2"])
def test_other_errors_of_regression(spark, metric):
    nested, apart = _both(spark, "rf_reg", {"maxDepth": [1, 3]}, metric=metric, **ONE)
    np.testing.assert_allclose(nested, apart, rtol=1e-9)


def test_area_under_precision_and_recall(spark):
    nested, apart = _both(spark, "tree", {"maxDepth": [1, 3]}, metric="areaUnderPR")
    np.testing.assert_allclose(nested, apart, rtol=1e-6)


@pytest.mark.parametrize("kind", ["rf_reg", "rf_cls"])
def test_the_whole_forest_equals_its_own_fit(spark, kind):
    # fewer trees are prefixes of this forest; all of them are the very forest of a separate fit
    nested, apart = _both(spark, kind, {"maxDepth": [2, 5], "numTrees": [3, 7]})
    np.testing.assert_allclose(nested[:, [1, 3]], apart[:, [1, 3]], rtol=1e-9)
    assert np.isfinite(nested).all()


def test_prefixes_are_the_first_trees(spark):
    df = _frame(spark)
    roles = standins.CHURN_ORDERS_ROLES
    for kind, label in (("rf_reg", "y"), ("rf_cls", "label")):
        est = models.estimator(kind, label=label, numTrees=5, maxDepth=4)
        pipe = models.build_pipeline(roles, est, encode="index", label_source=None if label == "y" else "churn").fit(df)
        rows = df
        for stage in pipe.stages[:-1]:
            rows = stage.transform(rows)
        model = pipe.stages[-1]
        got = forest_search.score_points(model, rows, label, [4, 9], [1, 3, 5], "rawPrediction")
        many = [np.array(r["scores"]).reshape(2, 3) for r in got.select("scores").collect()]
        assert all((a[0] == a[1]).all() for a in many)  # nothing lies below depth 4
        for j, k in enumerate((1, 3, 5)):
            votes = []
            for tree in model.trees[:k]:
                out = tree.transform(rows)
                value = F.col("prediction") if label == "y" else vector_to_array("probability")[1]
                votes.append([r[0] for r in out.select(value).collect()])
            want = np.sum(votes, axis=0) / (k if label == "y" else 1)
            np.testing.assert_allclose([a[0, j] for a in many], want, rtol=1e-9)


def test_bins_beyond_all_values_share_a_fit():
    assert forest_search.shared_bins([10, 20, 40, 80, 100], 50) == {10: 10, 20: 20, 40: 40, 80: 100, 100: 100}
    assert forest_search.shared_bins([80, 100, 200], 50) == {80: 100, 100: 100, 200: 200}  # 200 samples more rows
    assert forest_search.shared_bins([10, 20], 50) == {10: 10, 20: 20}


def test_other_searches_are_left_to_fits_of_their_own(spark):
    est = models.estimator("rf_cls")
    pipe = models.build_pipeline(standins.CHURN_ORDERS_ROLES, est, encode="index", label_source="churn")
    ev = models.evaluator("rf_cls")
    assert not forest_search.applies(pipe, models.grid(est, {"impurity": ["gini", "entropy"]}), ev)
    assert not forest_search.applies(pipe, models.grid(est, {"maxDepth": [2]}), models.evaluator("rf_cls", metric="f1"))
    line = models.estimator("logistic")
    assert not forest_search.applies(models.build_pipeline(standins.CHURN_ORDERS_ROLES, line), models.grid(line, {"maxIter": [2]}), ev)


def test_one_fit_per_fold_and_bins(spark, monkeypatch):
    fits = []
    cls = type(models.estimator("rf_reg"))
    plain = cls._fit
    monkeypatch.setattr(cls, "_fit", lambda self, data: fits.append((self.getMaxDepth(), self.getNumTrees(), self.getMaxBins())) or plain(self, data))
    df = _frame(spark)
    est = models.estimator("rf_reg", label="y")
    pipe = models.build_pipeline(standins.CHURN_ORDERS_ROLES, est, encode="index")
    cv = models.tune(pipe, models.grid(est, {"maxDepth": [1, 2, 3], "numTrees": [1, 2], "maxBins": [8, 16]}), models.evaluator("rf_reg", label="y"), df, folds=2, fold_col="fold", parallelism=2)
    assert sorted(fits[:-1]) == sorted([(3, 2, 8), (3, 2, 16)] * 2) and len(cv.avgMetrics) == 12
    best = int(np.argmin(cv.avgMetrics))
    assert fits[-1][0] == [1, 2, 3][best // 4] and sum(r.is_best for r in models.cv_table(cv).collect()) == 1


def test_layout_is_a_function_of_the_rows(spark):
    assert [models.layout_parts(n) for n in (0, 1, 16_384, 16_385, 10**6, 10**8, 10**12)] == [1, 1, 1, 2, 32, 96, 953_675]
    df = standins.churn_orders_frame(spark, SF_SMALL).withColumn("y", F.col("totalprice"))
    out = []
    for parts in (1, 8, 64):
        est = models.estimator("rf_reg", label="y", numTrees=4, maxDepth=5)
        model = models.fit(models.build_pipeline(standins.CHURN_ORDERS_ROLES, est, encode="index"), df.repartition(parts), "o_orderkey")
        out.append([t.toDebugString.split("\n", 1)[1] for t in model.stages[-1].trees])
    assert out[0] == out[1] == out[2]


def test_rows_without_a_key_are_spread(spark, monkeypatch):
    monkeypatch.setattr(models, "SMALL_PART", 100)
    df = spark.range(1000).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("x"))
    sizes = models.laid_out(df, "k").rdd.glom().map(len).collect()
    assert len(sizes) == 10 and max(sizes) < 200 and sum(sizes) == 1000


def test_searches_hold_the_rows_once(spark):
    df = _frame(spark)
    est = models.estimator("linear", label="y", solver="normal")
    pipe = models.build_pipeline(standins.CHURN_ORDERS_ROLES, est)
    seen = []
    ev = models.evaluator("linear", label="y")
    plain = type(ev)._evaluate
    held = spark.sparkContext._jsc.sc()
    try:
        type(ev)._evaluate = lambda self, data: seen.append(held.getRDDStorageInfo().__len__()) or plain(self, data)
        models.tune(pipe, models.grid(est, {"regParam": [0.0, 0.1]}), ev, df, folds=2, fold_col="fold", columns=["o_orderpriority", "totalprice", "order_year", "order_month", "y"])
    finally:
        type(ev)._evaluate = plain
    assert set(seen) == {1}


def test_grouped_curves_equal_those_of_each_group(spark):
    df = spark.range(4000).select((F.col("id") % 4).alias("m"), (F.xxhash64("id") % 3 == 0).cast("double").alias("label"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(97)) / 97.0).alias("score"))
    df = df.withColumn("prediction", (F.col("score") > 0.5).cast("double")).withColumn("label", F.when(F.col("m") == 3, 0.0).otherwise(F.col("label")))
    together = {r["m"]: r for r in evaluate.classifier_metrics(df, ["m"]).collect()}
    for m in range(4):
        one = df.filter(F.col("m") == m)
        areas, hard = evaluate.exact_curve_areas(one, "label", "score").first(), evaluate.auc_hard(one).first()[0]
        got = together[m]
        for a, b in ((areas.auc, got.auc_score), (areas.auc_pr, got.auc_pr), (hard, got.auc_hard), (evaluate.auc_swapped(one).first()[0], got.auc_swapped), (evaluate.accuracy(one).first().accuracy, got.accuracy)):
            assert (a is None) == (b is None) and (a is None or math.isclose(a, b))

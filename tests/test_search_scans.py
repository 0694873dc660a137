"""Searches read their rows a fixed number of times, whatever the grid."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.operators.columns import Roles
from tabula.operators.evaluate import curve_areas
from tabula.plans import forest_search, linear_search, models


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x, z = rng.normal(1000.0, 2.0, 400), rng.integers(0, 3, 400)
    y = 5.0 * x + 2.0 * z + rng.normal(0.0, 1.0, 400)
    table = [(float(a), f"c{b}", float(c), i % 3, float(c > 5002.0)) for i, (a, b, c) in enumerate(zip(x, z, y, strict=True))]
    return spark.createDataFrame(table, "x double, c string, label double, fold int, y double").persist()


def _linear(**params):
    est = models.estimator("linear", **params)
    return est, models.build_pipeline(Roles(categorical=("c",), numeric=("x",), label="label"), est)


@pytest.mark.parametrize("metric", ["rmse", "mse"])
def test_linear_search_equals_fits_on_the_rows(rows, metric):
    est, pipe = _linear()
    maps = models.grid(est, {"regParam": [0.1, 0.01], "elasticNetParam": [0.0, 0.5], "fitIntercept": [True, False]})
    ev = models.evaluator("linear", metric=metric)
    assert linear_search.applies(pipe, maps, ev)
    got = linear_search.search(pipe, maps, ev, rows, "fold", 3, 4)
    assert np.allclose(got, models._fold_metrics(pipe, maps, ev, rows, "fold", 3, 4), rtol=1e-6)
    plain, short = pipe.fit(rows, maps[0]).stages[-1], linear_search.refit(pipe, rows, maps[0]).stages[-1]
    assert np.allclose(plain.coefficients.toArray(), short.coefficients.toArray(), rtol=1e-6, atol=1e-9)
    assert not short.isDefined(short.weightCol)


def test_linear_search_reads_the_rows_alike_for_any_grid(spark, rows):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    est, pipe = _linear()
    frame = rows.select("x", "c", "label", "fold").mapInArrow(count, "x double, c string, label double, fold int")
    reads = []
    for space in ({"regParam": [0.1]}, {"regParam": [0.1, 0.2, 0.3, 0.4], "tol": [1e-4, 1e-8]}):
        before = seen.value
        models.tune(pipe, models.grid(est, space), models.evaluator("linear"), frame.persist(), folds=3, fold_col="fold")
        frame.unpersist()
        reads.append(seen.value - before)
    calls = []
    whole = type(pipe).fitMultiple
    type(pipe).fitMultiple = lambda self, *a: calls.append(1) or whole(self, *a)
    try:
        models.tune(pipe, models.grid(est, {"regParam": [0.1, 0.2]}), models.evaluator("linear"), rows, folds=3, fold_col="fold")
    finally:
        type(pipe).fitMultiple = whole
    assert reads[0] == reads[1] and not calls


def test_missing_numbers_fail_as_on_the_rows(rows):
    est, pipe = _linear()
    broken = rows.withColumn("label", F.when(F.col("x") > 1000, F.col("label")))
    with pytest.raises(Exception, match="(?i)label|null"):
        models.tune(pipe, models.grid(est, {"regParam": [0.1]}), models.evaluator("linear"), broken, folds=3, fold_col="fold")


def test_rows_of_a_leaf_are_scored_as_one(rows):
    est = models.estimator("tree", label="y")
    pipe = models.build_pipeline(Roles(categorical=("c",), numeric=("x",)), est, encode="index")
    model = pipe.fit(rows, {est.maxDepth: 2})
    ready = model.transform(rows).drop("rawPrediction", "probability", "prediction")
    scored = forest_search.score_points(model.stages[-1], ready, "y", [1, 2], [1], "rawPrediction")
    assert scored.count() <= 8
    assert scored.agg(F.sum("n")).first()[0] == rows.count()


def test_weighted_ladder(spark):
    df = spark.createDataFrame([(1.0, 0.3, 2), (0.0, 0.3, 1), (1.0, 0.9, 3), (0.0, 0.1, 4)], "label double, score double, n long").withColumn("k", F.lit(1))
    spread = df.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("i")
    assert curve_areas(df, ["k"], "label", "score", weight="n").collect() == curve_areas(spread, ["k"], "label", "score").collect()


def test_solver_is_given_a_row_a_class(spark, tmp_dir, monkeypatch):
    from tabula.plans import registry
    table = [(i, 1, "R" if i % 3 else "A") for i in range(300)]
    spark.createDataFrame(table, "l_orderkey long, l_linenumber int, l_returnflag string").write.parquet(f"{tmp_dir}/lineitem.parquet")
    given, make = [], models.estimator

    def watched(kind, **params):
        est = make(kind, **params)
        fit = est.fit
        est.fit = lambda df: given.append(df.count()) or fit(df)
        return est

    monkeypatch.setattr(models, "estimator", watched)
    out = registry.QUERIES["l4_separable_classes"](spark, tmp_dir).collect()
    assert given == [2] and all(r["prediction"] == float(r["l_orderkey"] % 3 > 0) for r in out) and len(out) == 300

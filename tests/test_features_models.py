import math

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tabula.operators import sampling
from tabula.operators.columns import Roles
from tabula.plans import features, models, standins


def test_index_order_frequency_then_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "v string")
    m = features.string_index("v").fit(df)
    assert m.labelsArray[0] == ["c", "a", "b"]


def test_unseen_value_and_null_get_the_extra_index(spark):
    train = spark.createDataFrame([("x",), ("y",), ("y",)], "v string")
    test = spark.createDataFrame([("z",), (None,), ("y",)], "v string")
    out = features.string_index("v").fit(train).transform(test)
    assert sorted(r.idx_v for r in out.collect()) == [0.0, 2.0, 2.0]


def test_one_hot_drop_last_strict(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "v string")
    pipe = Pipeline(stages=[features.string_index("v", invalid="error"),
                            features.one_hot("idx_v", ["vec"], invalid="error")])
    out = pipe.fit(df).transform(df).select("v", vector_to_array("vec").alias("a"))
    got = {r.v: r.a for r in out.collect()}
    assert got == {"c": [1.0, 0.0], "a": [0.0, 1.0], "b": [0.0, 0.0]}


def test_scaler_divides_by_sample_stddev(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    pipe = Pipeline(stages=[features.assemble(["x"], "fa"), features.scale("fa", "f")])
    out = [r.a[0] for r in pipe.fit(df).transform(df).select(vector_to_array("f").alias("a")).collect()]
    sd = 1.2909944487358056
    assert all(math.isclose(o, x / sd) for o, x in zip(out, [1.0, 2.0, 3.0, 4.0]))


def test_feature_columns(spark):
    r = Roles(categorical=("a", "b"), numeric=("x",), label="y")
    assert features.feature_columns(r) == ["a_Vector", "b_Vector", "x"]
    assert features.feature_columns(r, "index") == ["idx_a", "idx_b", "x"]


def test_grid_sizes():
    from pyspark.ml.regression import LinearRegression
    est = LinearRegression()
    g = models.grid(est, {"regParam": [0.1, 0.01], "maxIter": [10, 100], "tol": [1e-8, 1e-4],
                          "elasticNetParam": [0.001, 0.01]})
    assert len(g) == 16


def test_label_order_is_fixed(spark):
    df = standins.churn_orders_frame(spark, SF_SMALL)
    m = models.build_pipeline(standins.CHURN_ORDERS_ROLES, models.estimator("logistic", maxIter=5),
                              label_source="churn").fit(df)
    out = m.transform(df).select("churn", "label").distinct().collect()
    assert {r.churn: r.label for r in out} == {"False": 0.0, "True": 1.0}


def test_importances_named_per_slot(spark):
    df = standins.bike_frame(spark, SF_SMALL)
    est = models.estimator("rf_reg", label="cnt", numTrees=5, maxDepth=3, seed=1)
    m = models.build_pipeline(standins.BIKE_ROLES, est, scale_features=True).fit(df)
    imp = models.feature_importances(m, m.transform(df)).collect()
    size = len(m.stages[-1].featureImportances)
    assert len(imp) == size
    assert math.isclose(sum(r.importance for r in imp), 1.0, rel_tol=1e-9)
    names = [r.feature for r in imp]
    assert "hr" in names and any(n.startswith("season_Vector") for n in names)


def test_cv_with_fold_column(spark):
    df = sampling.with_folds(standins.churn_orders_frame(spark, SF_SMALL), "o_orderkey", 3, seed=7)
    est = models.estimator("tree")
    pipe = models.build_pipeline(standins.CHURN_ORDERS_ROLES, est, encode="index", label_source="churn")
    cv = models.tune(pipe, models.grid(est, {"maxDepth": [2, 3]}), models.evaluator("tree"), df,
                     folds=3, parallelism=2, fold_col="fold")
    t = models.cv_table(cv).collect()
    assert len(t) == 2 and sum(r.is_best for r in t) == 1
    bp = {r.param: r.value for r in models.best_params(cv).collect()}
    assert bp["maxDepth"] in ("2", "3")


def test_reused_keeps_the_layout_unless_one_is_asked_for(spark):
    from pyspark import StorageLevel
    one = spark.range(50_000).coalesce(1)
    with models.reused(one) as held:  # whatever the cores and the rows
        assert held.rdd.getNumPartitions() == 1 and held.storageLevel != StorageLevel.NONE
    assert held.storageLevel == StorageLevel.NONE  # released afterwards
    with models.reused(one, keys="id") as held:
        parts = held.rdd.glom().map(lambda rows: [r.id for r in rows]).collect()
    with models.reused(one.repartition(7), keys="id") as held:
        again = held.rdd.glom().map(lambda rows: [r.id for r in rows]).collect()
    assert parts == again and len(parts) == models.layout_parts(50_000) == 4 and all(p == sorted(p) for p in parts)
    kept = spark.range(5).persist()
    with models.reused(kept) as held:
        assert held is kept
    assert kept.storageLevel != StorageLevel.NONE  # the caller's cache is left alone
    kept.unpersist()


def test_forests_repeat_on_any_input_layout(spark):
    df = standins.churn_orders_frame(spark, SF_SMALL)
    out = []
    for frame in (df, df.repartition(6)):
        est = models.estimator("rf_cls", numTrees=5, maxDepth=4)
        pipe = models.build_pipeline(standins.CHURN_ORDERS_ROLES, est, encode="index", label_source="churn")
        out.append(models.fit(pipe, frame, "o_orderkey").stages[-1].featureImportances.toArray().tolist())
    assert out[0] == out[1]
    assert models.estimator("tree").getSeed() == models.estimator("rf_reg").getSeed() == models.SEED


def test_missing_numbers_fail_skip_or_fill_in_every_kind(spark):
    import pytest
    from pyspark.sql import functions as F
    df = standins.churn_orders_frame(spark, SF_SMALL).withColumn("totalprice", F.when(F.col("o_orderkey") % 5 != 0, F.col("totalprice")))
    df = df.withColumn("y", (F.col("churn") == "True").cast("double"))
    whole = df.filter("totalprice is not null").count()
    for kind in models._ESTIMATORS:
        params = {"numTrees": 2, "maxDepth": 2} if kind.startswith("rf") else {"maxDepth": 2} if kind == "tree" else {"maxIter": 3}
        roles = standins.CHURN_ORDERS_ROLES
        made = {m: models.build_pipeline(roles, models.estimator(kind, label="y", **params), encode="index", missing=m) for m in ("error", "skip", "mean")}
        with pytest.raises(Exception, match="null|Null"):
            models.fit(made["error"], df)
        assert models.fit(made["skip"], df).transform(df).count() == whole
        assert models.fit(made["mean"], df).transform(df).count() == df.count()


def test_selection_is_exact_on_many_scores_and_by_either_column(spark):
    from pyspark.sql import functions as F
    from pyspark.ml.functions import array_to_vector
    from tabula.operators import evaluate
    df = spark.range(6000).select((F.xxhash64("id") % 2 == 0).cast("double").alias("label"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100003)) / 100003).alias("s"))
    df = df.withColumn("s", F.col("s") + 0.1 * F.col("label")).withColumn("prediction", (F.col("s") > 0.5).cast("double"))
    df = df.withColumn("rawPrediction", array_to_vector(F.array(-F.col("s"), F.col("s"))))
    exact = evaluate.exact_curve_areas(df, "label", "s").first()
    assert math.isclose(models.evaluator("logistic").evaluate(df), exact.auc, rel_tol=1e-9)
    assert math.isclose(models.evaluator("logistic", metric="areaUnderPR").evaluate(df), exact.auc_pr, rel_tol=1e-6)
    hard = evaluate.auc_hard(df).first()[0]
    assert math.isclose(models.evaluator("logistic", column="prediction").evaluate(df), hard, rel_tol=1e-9)


def test_bins_are_raised_to_what_the_categories_need(spark):
    df = standins.churn_frame(spark, SF_SMALL)
    least = models.nominal_bins(df, standins.CHURN_ROLES)
    assert least == 1 + max(df.select("lang").distinct().count(), df.select("source").distinct().count())
    assert models.at_least_bins({"maxBins": [2, 3, 100], "maxDepth": [2]}, least) == {"maxBins": sorted({least, 100}), "maxDepth": [2]}


def test_shared_prefix_grid_search_equals_plain_pipeline(spark):
    from pyspark.ml import Pipeline
    df = sampling.with_folds(standins.churn_orders_frame(spark, SF_SMALL), "o_orderkey", 3, seed=7)
    est = models.estimator("logistic", maxIter=15)
    shared = models.build_pipeline(standins.CHURN_ORDERS_ROLES, est, label_source="churn")
    assert isinstance(shared, models.SharedPrefixPipeline)
    plain = Pipeline(stages=shared.getStages())
    g = models.grid(est, {"regParam": [0.1, 0.01], "elasticNetParam": [0.0, 0.5]})
    ev = models.evaluator("logistic")
    a = models.tune(shared, g, ev, df, folds=3, parallelism=3, fold_col="fold")
    b = models.tune(plain, g, ev, df, folds=3, parallelism=1, fold_col="fold")
    assert [round(x, 12) for x in a.avgMetrics] == [round(x, 12) for x in b.avgMetrics]
    # one indexer model shared by every map of a fold
    it = shared.fitMultiple(df, g)
    fitted = [m for _, m in it]
    assert len({id(m.stages[0]) for m in fitted}) == 1
    assert {m.stages[-1].getRegParam() for m in fitted} == {0.1, 0.01}


def test_shared_prefix_falls_back_when_grid_touches_encoders(spark):
    df = standins.churn_orders_frame(spark, SF_SMALL)
    est = models.estimator("logistic", maxIter=5)
    pipe = models.build_pipeline(standins.CHURN_ORDERS_ROLES, est, label_source="churn")
    indexer = pipe.getStages()[0]
    g = models.grid(indexer, {"handleInvalid": ["keep", "skip"]})
    fitted = [m for _, m in pipe.fitMultiple(df, g)]
    assert {m.stages[0].getHandleInvalid() for m in fitted} == {"keep", "skip"}


def test_grid_search_workers_get_private_local_properties(spark):
    # CrossValidator wraps all of a fold's tasks with one inheritable_thread_target
    # call, so its workers start on one shared Properties object; ours copy it first.
    from concurrent.futures import ThreadPoolExecutor
    from pyspark.util import inheritable_thread_target
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext._jsc.sc()
    ident = lambda: jvm.System.identityHashCode(sc.getLocalProperties())
    it = models._ModelsByIndex(spark, lambda i: ident(), 2)
    wrap = inheritable_thread_target(spark)

    def task():
        shared = ident()
        _, own = next(it)
        return shared, own

    with ThreadPoolExecutor(2) as pool:
        (s1, o1), (s2, o2) = pool.map(lambda f: f(), [wrap(task), wrap(task)])
    assert s1 == s2  # the hand-off shares one object ...
    assert len({s1, o1, o2}) == 3  # ... and each worker continues on its own copy


def test_tree_estimators_cache_node_ids():
    for kind in ("tree", "rf_cls", "rf_reg"):
        assert models.estimator(kind).getCacheNodeIds()
    assert models.estimator("tree", cacheNodeIds=False).getCacheNodeIds() is False

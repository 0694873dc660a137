"""Estimators, pipelines, grid search, and model introspection as DataFrames."""

from __future__ import annotations

import math
import threading
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial, reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.feature import Imputer, ImputerModel, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import Roles
from . import forest_search, linear_search
from .features import assemble, feature_columns, one_hot, scale, string_index

_ESTIMATORS = {
    "linear": LinearRegression,
    "rf_reg": RandomForestRegressor,
    "logistic": LogisticRegression,
    "svc": LinearSVC,
    "tree": DecisionTreeClassifier,
    "rf_cls": RandomForestClassifier,
}
CLASSIFIERS = {"logistic", "svc", "tree", "rf_cls"}

# The workloads' hyper-parameter grids (each searched with 3 folds).
WORKLOAD_GRIDS = {
    "linear": {"regParam": [0.1, 0.01], "maxIter": [10, 100], "tol": [1e-8, 1e-4],
               "elasticNetParam": [0.001, 0.01]},
    "rf_reg": {"maxDepth": [2, 5, 10, 20, 30], "maxBins": [10, 20, 40, 80, 100],
               "numTrees": [10, 30, 100]},
    "logistic": {"regParam": [0.1, 0.01], "fitIntercept": [False, True],
                 "elasticNetParam": [0.0, 0.5, 1.0]},
    "svc": {"regParam": [0.1, 0.01], "maxIter": [1000], "tol": [1e-8]},
    "tree": {"maxDepth": [2, 5, 10, 20, 30], "maxBins": [10, 20, 40, 80, 100]},
    "rf_cls": {"maxDepth": [2, 5, 10, 20, 30], "maxBins": [10, 20, 40, 80, 100],
               "numTrees": [10, 30, 100]},
}


def nominal_bins(df: DataFrame, roles: Roles) -> int:
    """Smallest ``maxBins`` a tree accepts for the roles' categories: the largest number of
    values of one column, and one for unseen values.  One scan, one number per column."""
    if not roles.categorical:
        return 2
    row = df.agg(*[F.countDistinct(c).alias(f"c{i}") for i, c in enumerate(roles.categorical)]).first()
    return max(2, *(n + 1 for n in row))


def at_least_bins(params: dict, least: int) -> dict:
    """The grid with every ``maxBins`` raised to what the categories need, without repeats."""
    if "maxBins" not in params:
        return params
    return params | {"maxBins": sorted({max(b, least) for b in params["maxBins"]})}


TREE_KINDS = {"rf_reg", "tree", "rf_cls"}
#: PySpark's own default seed is a per-process string hash; this one repeats.
SEED = 27


def estimator(kind: str, features: str = "features", label: str = "label", **params):
    """A Spark ML estimator by short name: linear, rf_reg, logistic, svc, tree, rf_cls.

    Tree estimators cache each row's node id on the executors (``cacheNodeIds``)
    instead of shipping the growing trees to every task at each level; the
    cache is checkpointed every ``checkpointInterval`` levels into the shared
    checkpoint folder.  Same trees; it matters for the deep workload grids
    (depth up to 30) and measured neutral at depth 5.  Their seed is fixed.
    """
    cls = _ESTIMATORS[kind]
    est = cls(featuresCol=features, labelCol=label)
    if kind in TREE_KINDS:
        est = est.setCacheNodeIds(True).setSeed(SEED)
    if params:
        est = est.setParams(**params)
    return est


def _own_local_properties(spark: SparkSession) -> None:
    """Give the calling thread its own copy of the SparkContext local properties.

    ``CrossValidator`` hands all worker threads of a fold one shared Java
    ``Properties`` object (it wraps its tasks once with
    ``inheritable_thread_target``).  SQL executions running at the same time
    set and clear their execution-id entries on that one object, and a thread
    can then read a just-cleared entry ("Cannot parse null string").  A private
    copy per thread, taken before the thread runs any job, removes the race.
    """
    try:
        jsc = spark.sparkContext._jsc.sc()
    except Exception:  # noqa: BLE001 - Spark Connect: no JVM context on the client
        return
    jsc.setLocalProperties(jsc.getLocalProperties().clone())


class _ModelsByIndex:
    """Thread-safe iterator of ``(index, model)``: the contract ``fitMultiple`` has with
    ``CrossValidator``, whose worker threads each take the next index and fit it
    (and then evaluate it, in the same thread)."""

    def __init__(self, spark: SparkSession, fit_one, count: int):
        self._spark, self._fit_one, self._count, self._next = spark, fit_one, count, 0
        self._lock = threading.Lock()

    def __iter__(self):
        return self

    def __next__(self):
        with self._lock:
            index = self._next
            if index >= self._count:
                raise StopIteration
            self._next += 1
        _own_local_properties(self._spark)
        return index, self._fit_one(index)


class SharedPrefixPipeline(Pipeline):
    """A ``Pipeline`` whose grid search fits the encoding stages once per training frame.

    ``CrossValidator`` asks the estimator for one model per parameter map and
    fold; a plain ``Pipeline`` then refits every stage for every map, so each
    indexer/one-hot/scaler pass over the fold runs once per grid point (75
    times per fold for the largest workload grid).  When every map only sets
    parameters of the last stage, the stages before it see the same rows with
    the same parameters each time and give the same fitted models, so they
    are fitted once and shared; only the last stage is fitted per map.  Any
    other grid fits the whole pipeline per map.  Either way each worker thread
    runs on its own copy of the local properties (see ``_own_local_properties``).
    ``fit`` is unchanged.
    """

    def fitMultiple(self, dataset, paramMaps):
        stages = self.getStages()
        last = stages[-1] if stages else None
        spark = dataset.sparkSession
        if (len(stages) < 2 or not isinstance(last, Estimator)
                or any(p.parent != last.uid for m in paramMaps for p in m)):
            whole = self.copy()
            return _ModelsByIndex(spark, lambda i: whole.fit(dataset, paramMaps[i]), len(paramMaps))
        lock = threading.Lock()
        shared: dict = {}

        def head():
            with lock:  # concurrent fits wait for the one prefix fit
                if "model" not in shared:
                    model = Pipeline(stages=stages[:-1]).fit(dataset)
                    shared["model"] = model
                    shared["rows"] = model.transform(dataset)
                return shared["model"], shared["rows"]

        def fit_one(index: int) -> PipelineModel:
            prefix, rows = head()
            return PipelineModel(stages=list(prefix.stages) + [last.fit(rows, paramMaps[index])])

        return _ModelsByIndex(spark, fit_one, len(paramMaps))


def build_pipeline(roles: Roles, est, encode: str = "onehot", scale_features: bool = False,
                   label_source: str | None = None, label_order: str = "alphabetAsc",
                   invalid: str = "keep", missing: str = "error") -> Pipeline:
    """index → (one-hot) → assemble → (scale) → estimator, all inside one pipeline so
    cross-validation refits the encoders on each training fold.

    ``label_source``: a string label column to index into ``label`` with a fixed
    (alphabetical) order, so the class that becomes 1.0 never depends on a sample.
    ``invalid``: NULL and unseen categories (``keep``: a category of their own).
    ``missing``: rows with a NULL numeric feature: ``error`` (clean them first),
    ``skip`` (left out) or ``mean`` (the training rows' mean).
    """
    stages = []
    if roles.categorical:
        stages.append(string_index(list(roles.categorical),
                                   [roles.index_name(c) for c in roles.categorical],
                                   invalid=invalid))
        if encode == "onehot":
            stages.append(one_hot([roles.index_name(c) for c in roles.categorical],
                                  [roles.vector_name(c) for c in roles.categorical]))
    if label_source:
        stages.append(string_index(label_source, [est.getLabelCol()], order=label_order,
                                   invalid="error"))
    inputs = feature_columns(roles, encode)
    if missing == "mean" and roles.numeric:
        filled = [f"{c}_filled" for c in roles.numeric]
        stages.append(Imputer(inputCols=list(roles.numeric), outputCols=filled, strategy="mean"))
        inputs = inputs[: len(inputs) - len(filled)] + filled
    invalid_rows = "skip" if missing == "skip" else "error"
    if scale_features:
        stages.append(assemble(inputs, "features_assembler", invalid=invalid_rows))
        stages.append(scale("features_assembler", est.getFeaturesCol()))
    else:
        stages.append(assemble(inputs, est.getFeaturesCol(), invalid=invalid_rows))
    stages.append(est)
    return SharedPrefixPipeline(stages=stages)


def fit(pipeline: Pipeline, train: DataFrame, keys=None) -> PipelineModel:
    """Fit every stage; the training rows are held once for the stages' passes (``reused``)."""
    with reused(train, keys) as frame:
        return pipeline.fit(frame)


def score(model, df: DataFrame) -> DataFrame:
    """Append prediction columns to any frame (lazy projection)."""
    return model.transform(df)


def label_free(model: PipelineModel) -> PipelineModel:
    """A copy of a fitted pipeline that scores rows without a label: the stages that
    make the final stage's label column are left out."""
    label = model.stages[-1].getLabelCol()

    def makes_label(stage) -> bool:
        return any(stage.hasParam(p) and stage.isDefined(p) and label in [stage.getOrDefault(p)] for p in ("outputCol",))

    return PipelineModel([s for s in model.stages[:-1] if not makes_label(s)] + [model.stages[-1]])


def drift_report(model: PipelineModel, df: DataFrame) -> DataFrame:
    """column_name, kind, n_rows, n_null, n_unseen: how a frame to be scored differs from the training rows.

    Categories are looked up by the pipeline's own indexers, so ``n_unseen``
    counts the rows whose value gets the code of unknown ones; numbers have
    no unseen values, ``n_null`` also counts those that are not a number.  One scan.
    """
    stages = label_free(model).stages
    looked_up, made = df, []
    for stage in stages:
        if isinstance(stage, StringIndexerModel):
            many = stage.isSet("inputCols")
            ins, outs = (stage.getInputCols(), stage.getOutputCols()) if many else ([stage.getInputCol()], [stage.getOutputCol()])
            looked_up = stage.copy().setHandleInvalid("keep").transform(looked_up)
            made += zip(ins, outs, map(len, stage.labelsArray), strict=True)
    derived = {c for s in stages for p in ("outputCol", "outputCols") if s.hasParam(p) and s.isDefined(p)
               for c in np.atleast_1d(s.getOrDefault(p)).tolist()}
    read = [c for s in stages if isinstance(s, (VectorAssembler, ImputerModel)) for c in s.getInputCols()]
    numbers = [c for c in dict.fromkeys(read) if c not in derived]
    rows = [("category", c, F.col(f"`{c}`").isNull(), (F.col(o) == size) & F.col(f"`{c}`").isNotNull()) for c, o, size in made]
    rows += [("number", c, F.col(f"`{c}`").isNull() | F.isnan(F.col(f"`{c}`").cast("double")), F.lit(False)) for c in numbers]
    wide = looked_up.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(x).alias(f"{n}{i}") for i, (_, _, a, b) in enumerate(rows) for n, x in (("a", a), ("b", b))])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("kind"), F.col("n_rows"), F.col(f"a{i}").alias("n_null"), F.col(f"b{i}").alias("n_unseen")) for i, (kind, c, _, _) in enumerate(rows)]))
    return wide.select(each.alias("x")).select("x.*")


def grid(est, params: dict) -> list:
    """Cartesian parameter grid; keys are param names of ``est``."""
    b = ParamGridBuilder()
    for name, values in params.items():
        b = b.addGrid(est.getParam(name), list(values))
    return b.build()


def evaluator(kind: str, label: str = "label", metric: str | None = None, column: str | None = None):
    """What a search maximises or minimises: RMSE for regressors, else the exact area under
    the curve (no binning of the thresholds) of ``column``: ``rawPrediction``, or
    ``prediction`` for the area of the hard decision."""
    if kind in ("linear", "rf_reg"):
        return RegressionEvaluator(labelCol=label, predictionCol="prediction",
                                   metricName=metric or "rmse")
    if metric in (None, "areaUnderROC", "areaUnderPR"):
        return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=column or "rawPrediction",
                                             metricName=metric or "areaUnderROC", numBins=0)
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                             metricName=metric)


#: A layout has a part per so many rows, ...
ROWS_A_PART = 1 << 20
#: ... but small tables are cut finer, up to so many parts.
SMALL_PART, SMALL_PARTS = 1 << 14, 32


def layout_parts(rows: int) -> int:
    """Parts of the layout for ``rows`` rows: a function of the data alone, in proportion to it."""
    return max(1, min(SMALL_PARTS, -(-rows // SMALL_PART)), -(-rows // ROWS_A_PART))


def laid_out(df: DataFrame, keys) -> DataFrame:
    """The rows in parts by hash of ``keys``, each sorted by them; rows without a key are dealt by their content.

    Spark draws a forest's rows per part and position.  The layout depends on
    the rows alone, not on files, cores or shuffle settings, so the same rows
    give the same forest on any cluster; the parts grow in number with them.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    lone = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    dealt = df.repartition(layout_parts(df.count()), *keys, F.when(lone, F.xxhash64(*df.columns)))
    return dealt.sortWithinPartitions(*keys, *[c for c in df.columns if c not in keys])


@contextmanager
def reused(df: DataFrame, keys=None):
    """Hold a frame that many jobs will read (fold filters, every fit, the refit).

    Without this each of those jobs re-runs the scan, the hash columns and any
    shuffle below the frame.  ``MEMORY_AND_DISK`` spills rather than fails
    when the frame outgrows executor memory; blocks lost with an executor are
    recomputed from lineage.  A frame the caller already persisted is used as
    is and left persisted.

    The frame keeps its partitions, unless ``keys`` ask for a layout that
    makes fits repeat (``laid_out``).
    """
    if df.storageLevel != StorageLevel.NONE:
        yield df
        return
    held = (laid_out(df, keys) if keys else df).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        held.count()  # fill once, before concurrent fits race to compute it
        yield held
    finally:
        held.unpersist()


class SearchResult:
    """What a grid search found; the part of ``CrossValidatorModel`` that callers use."""

    def __init__(self, best_model, param_maps: list, ev, by_fold: np.ndarray):
        self.bestModel, self._maps, self._evaluator = best_model, param_maps, ev
        self.avgMetrics, self.stdMetrics = by_fold.mean(axis=0).tolist(), by_fold.std(axis=0).tolist()

    def getEstimatorParamMaps(self) -> list:
        return self._maps

    def getEvaluator(self):
        return self._evaluator

    def transform(self, df: DataFrame) -> DataFrame:
        return self.bestModel.transform(df)


def _fold_metrics(pipeline: Pipeline, param_maps: list, ev, frame: DataFrame, fold_col: str, folds: int, parallelism: int) -> np.ndarray:
    """Metric of every (fold, grid point): a fit each, on filters of the one held frame,
    ``parallelism`` at a time whatever fold they belong to."""
    parts = [(frame.filter(F.col(fold_col) != k), frame.filter(F.col(fold_col) == k)) for k in range(folds)]
    fitted = [iter(pipeline.fitMultiple(train, param_maps)) for train, _ in parts]

    def one(fold: int) -> tuple[int, int, float]:
        index, model = next(fitted[fold])
        return fold, index, ev.evaluate(model.transform(parts[fold][1], param_maps[index]))

    out = np.empty((folds, len(param_maps)))
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        for fold, index, value in pool.map(one, np.repeat(np.arange(folds), len(param_maps)).tolist()):
            out[fold, index] = value
    return out


def tune(pipeline: Pipeline, param_maps: list, ev, train: DataFrame, folds: int = 3,
         parallelism: int = 1, fold_col: str | None = None, seed: int = 42,
         columns=None, keys=None):
    """k-fold grid search and refit of the best map on all rows.

    With ``fold_col`` (see ``with_folds``) fold membership is a pure function
    of the row key, so results repeat on any layout.  The frame is then held
    once, each fold a filter on it, and searches over depth, trees and bins of
    a tree or forest fit once per fold and bins (``forest_search``), searches of
    a linear regression fit on the folds' moments (``linear_search``).  Without
    it Spark's own cross-validation draws the folds.

    ``columns``: what the pipeline reads; only those (and the fold) are held.
    ``keys``: ask for the layout that makes forests repeat (``laid_out``).
    """
    if columns is not None:
        train = train.select(*dict.fromkeys([*columns, *([fold_col] if fold_col else []), *([keys] if isinstance(keys, str) else keys or [])]))
    with reused(train, keys) as frame:
        if not fold_col:
            return CrossValidator(estimator=pipeline, estimatorParamMaps=param_maps, evaluator=ev,
                                  numFolds=folds, parallelism=parallelism, seed=seed).fit(frame)
        measure, refit = _fold_metrics, pipeline.fit
        if isinstance(pipeline, Pipeline) and forest_search.applies(pipeline, param_maps, ev):
            measure, refit = forest_search.search, partial(forest_search.refit, pipeline)
        elif isinstance(pipeline, Pipeline) and linear_search.applies(pipeline, param_maps, ev):
            measure, refit = linear_search.search, partial(linear_search.refit, pipeline)
        found = measure(pipeline, param_maps, ev, frame, fold_col, folds, parallelism)
        average = found.mean(axis=0)
        worst = -np.inf if ev.isLargerBetter() else np.inf
        average = np.where(np.isnan(average), worst, average)
        best = int(average.argmax() if ev.isLargerBetter() else average.argmin())
        return SearchResult(refit(frame, param_maps[best]), param_maps, ev, found)


def _final_stage(model):
    best = getattr(model, "bestModel", model)
    return best.stages[-1] if isinstance(best, PipelineModel) else best


_PARAM_SCHEMA = T.StructType([
    T.StructField("stage", T.StringType(), False),
    T.StructField("param", T.StringType(), False),
    T.StructField("value", T.StringType(), True),
])


def best_params(model, names=None) -> DataFrame:
    """stage, param, value for the final stage of the (best) model."""
    stage = _final_stage(model)
    spark = SparkSession.getActiveSession()
    rows = [(type(stage).__name__, p.name, str(v)) for p, v in stage.extractParamMap().items()
            if names is None or p.name in names]
    rows.sort(key=lambda r: r[1])
    return spark.createDataFrame(rows, _PARAM_SCHEMA)


_CV_SCHEMA = T.StructType([
    T.StructField("combo", T.LongType(), False),
    T.StructField("params", T.StringType(), False),
    T.StructField("avg_metric", T.DoubleType(), True),
    T.StructField("std_metric", T.DoubleType(), True),
    T.StructField("is_best", T.BooleanType(), False),
])


def cv_table(cv_model) -> DataFrame:
    """One row per grid combination: params, mean and std of the fold metric."""
    spark = SparkSession.getActiveSession()
    maps = cv_model.getEstimatorParamMaps()
    avg = list(cv_model.avgMetrics)
    std = list(getattr(cv_model, "stdMetrics", []) or [None] * len(avg))
    larger = cv_model.getEvaluator().isLargerBetter()
    best = max(range(len(avg)), key=lambda i: -math.inf if math.isnan(avg[i]) else avg[i] if larger else -avg[i])
    rows = []
    for i, m in enumerate(maps):
        desc = ", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name))
        a = None if avg[i] is None or math.isnan(avg[i]) else float(avg[i])
        s = None if std[i] is None or math.isnan(std[i]) else float(std[i])
        rows.append((i, desc, a, s, i == best))
    return spark.createDataFrame(rows, _CV_SCHEMA)


def slot_names(df: DataFrame, col: str) -> list[str]:
    """Slot names of a vector column from its ML attribute metadata."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    n = meta.get("num_attrs")
    names: dict[int, str] = {}
    for group in meta.get("attrs", {}).values():
        for a in group:
            names[a["idx"]] = a.get("name", f"slot_{a['idx']}")
    size = n if n is not None else (max(names) + 1 if names else 0)
    return [names.get(i, f"slot_{i}") for i in range(size)]


_IMP_SCHEMA = T.StructType([
    T.StructField("feature", T.StringType(), False),
    T.StructField("slot", T.LongType(), False),
    T.StructField("importance", T.DoubleType(), False),
])


def feature_importances(model, scored: DataFrame, vector_col: str | None = None) -> DataFrame:
    """feature, slot, importance — names read from the assembler output's metadata
    (one name per vector slot, so one-hot categories are named individually)."""
    stage = _final_stage(model)
    if vector_col is None:
        best = getattr(model, "bestModel", model)
        assemblers = [s for s in best.stages if type(s).__name__ == "VectorAssembler"]
        vector_col = assemblers[-1].getOutputCol() if assemblers else stage.getFeaturesCol()
    names = slot_names(scored, vector_col)
    imp = stage.featureImportances.toArray()
    spark = SparkSession.getActiveSession()
    rows = [(names[i] if i < len(names) else f"slot_{i}", i, float(v)) for i, v in enumerate(imp)]
    return spark.createDataFrame(rows, _IMP_SCHEMA)

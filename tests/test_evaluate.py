import math

from pyspark.ml.evaluation import (BinaryClassificationEvaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.sql import functions as F

from conftest import SF_MID
from tabula.operators import evaluate


def preds(spark):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    return li.select(
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"),
        F.when(F.col("l_quantity") > 30, 1.0).otherwise(0.0).alias("prediction"),
        (F.col("l_quantity") + F.col("l_discount")).alias("score"),
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2000.0).alias("yhat"))


def test_regression_matches_spark_evaluator(spark):
    df = preds(spark)
    m = evaluate.regression_metrics(df, "y", "yhat").first()
    for name in ("rmse", "mse", "mae", "r2"):
        ref = RegressionEvaluator(labelCol="y", predictionCol="yhat", metricName=name).evaluate(df)
        assert math.isclose(m[name], ref, rel_tol=1e-9), name


def test_auc_hard_equals_evaluator_on_hard_prediction(spark):
    df = preds(spark)
    ours = evaluate.auc_hard(df).first().auc_hard
    ref = BinaryClassificationEvaluator(rawPredictionCol="prediction", labelCol="label").evaluate(df)
    assert math.isclose(ours, ref, rel_tol=1e-12)


def test_auc_swapped_equals_evaluator_with_roles_exchanged(spark):
    df = preds(spark)
    ours = evaluate.auc_swapped(df).first().auc_swapped
    ref = BinaryClassificationEvaluator(rawPredictionCol="label", labelCol="prediction").evaluate(df)
    assert math.isclose(ours, ref, rel_tol=1e-12)


def test_exact_auc_matches_evaluator_when_scores_are_few(spark):
    df = preds(spark)  # ~50 distinct scores * few discounts: well under the evaluator's bins
    ours = evaluate.exact_auc(df, "label", "score").first().auc
    ref = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label").evaluate(df)
    assert math.isclose(ours, ref, rel_tol=1e-9)


def test_exact_auc_brute_force_small(spark):
    rows = [(1.0, 0.9), (0.0, 0.8), (1.0, 0.8), (0.0, 0.1), (1.0, 0.3), (0.0, 0.3)]
    df = spark.createDataFrame(rows, "label double, score double")
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert math.isclose(evaluate.exact_auc(df, "label", "score", partitions=3).first().auc, brute)


def test_one_class_gives_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0)], "label double, prediction double")
    assert evaluate.auc_hard(df).first().auc_hard is None
    assert evaluate.exact_auc(df, "label", "prediction").first().auc is None


def test_confusion_cells(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (0.0, 0.0), (1.0, 0.0), (0.0, 0.0)],
                               "label double, prediction double")
    c = evaluate.confusion(df).first()
    assert (c.total, c.correct, c.wrong, c.tp, c.fp, c.tn, c.fn) == (5, 3, 2, 1, 1, 2, 1)
    assert (c.pred0_correct, c.pred1_correct, c.pred1_wrong, c.pred0_wrong) == (0.4, 0.2, 0.2, 0.2)


def test_multiclass_matches_evaluator(spark):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    df = li.select(
        F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0).alias("label"),
        F.when(F.col("l_quantity") < 17, 0.0).when(F.col("l_quantity") < 34, 1.0).otherwise(2.0).alias("prediction"))
    m = evaluate.multiclass_metrics(df).first()
    for ours, name in [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                       ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1")]:
        ref = MulticlassClassificationEvaluator(metricName=name).evaluate(df)
        assert math.isclose(m[ours], ref, rel_tol=1e-9), name


def test_constant_label_r2_is_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double")
    m = evaluate.regression_metrics(df, "y", "p").first()
    assert m.r2 is None and m.rows == 2 and m.mae == 0.5


def test_exact_auc_with_one_score_holding_a_third_of_rows(spark):
    # a hot score value is one row after the first aggregation; result equals brute force
    from pyspark.sql import functions as F
    base = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise((F.col("id") % 97) / 97.0).alias("score"),
        (F.col("id") % 5 < 2).cast("double").alias("label"))
    pdf = base.toPandas()
    pos = pdf[pdf.label == 1].score.values
    neg = pdf[pdf.label == 0].score.values
    import numpy as np
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    brute = gt / (len(pos) * len(neg))
    ours = evaluate.exact_auc(base, "label", "score", partitions=4).first().auc
    assert math.isclose(ours, brute, rel_tol=1e-12)


def _brute_pr(labels, scores):
    """Trapezoids over the PR points of every distinct threshold, highest first,
    starting at (0, precision of the first threshold)."""
    P = sum(labels)
    pts = []
    for t in sorted(set(scores), reverse=True):
        tp = sum(1 for y, s in zip(labels, scores) if s >= t and y == 1)
        fp = sum(1 for y, s in zip(labels, scores) if s >= t and y == 0)
        pts.append((tp / P, tp / (tp + fp)))
    pts = [(0.0, pts[0][1])] + pts
    return sum((x1 - x0) * (y1 + y0) / 2 for (x0, y0), (x1, y1) in zip(pts, pts[1:]))


def test_exact_pr_auc_matches_evaluator_when_scores_are_few(spark):
    df = preds(spark)
    ours = evaluate.exact_pr_auc(df, "label", "score").first().auc_pr
    ref = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label",
                                        metricName="areaUnderPR").evaluate(df)
    assert math.isclose(ours, ref, rel_tol=1e-9)


def test_exact_pr_auc_brute_force_with_hot_score(spark):
    from pyspark.sql import functions as F
    base = spark.range(0, 600).select(
        F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise((F.col("id") % 37) / 37.0).alias("score"),
        (F.col("id") % 7 < 3).cast("double").alias("label"))
    pdf = base.toPandas()
    brute = _brute_pr(list(pdf.label), list(pdf.score))
    ours = evaluate.exact_pr_auc(base, "label", "score", partitions=5).first().auc_pr
    assert math.isclose(ours, brute, rel_tol=1e-12)
    # the first threshold being all negatives starts the curve at precision 0
    rows = [(0.0, 0.9), (1.0, 0.5), (0.0, 0.5), (1.0, 0.1)]
    df = spark.createDataFrame(rows, "label double, score double")
    assert math.isclose(evaluate.exact_pr_auc(df, "label", "score", partitions=2).first().auc_pr,
                        _brute_pr([r[0] for r in rows], [r[1] for r in rows]), rel_tol=1e-12)


def test_pr_auc_without_positives_is_null(spark):
    df = spark.createDataFrame([(0.0, 0.3), (0.0, 0.7)], "label double, score double")
    assert evaluate.exact_pr_auc(df, "label", "score").first().auc_pr is None


def test_curve_areas_from_one_ladder_equal_the_separate_areas(spark):
    df = preds(spark)
    both = evaluate.exact_curve_areas(df, "label", "score", partitions=3).first()
    assert math.isclose(both.auc, evaluate.exact_auc(df, "label", "score").first().auc, rel_tol=1e-12)
    assert math.isclose(both.auc_pr, evaluate.exact_pr_auc(df, "label", "score").first().auc_pr,
                        rel_tol=1e-12)

"""Evaluation as single-pass aggregates returning one-row (or long) DataFrames.

Every metric is computed on the executors; nothing is re-scored per row in
Python and no RDD of pairs is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import materialized


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def regression_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """rows, rmse, mse, mae, r2 in one scan (r2 = 1 - SS_err / SS_tot; SS_tot from the
    numerically stable sample variance)."""
    y, p = _c(label).cast("double"), _c(pred).cast("double")
    err = y - p
    a = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("sse"),
        F.var_samp(y).alias("vy"),
    )
    return a.select(
        F.col("rows").cast("long").alias("rows"),
        F.sqrt("mse").alias("rmse"),
        "mse",
        "mae",
        # NULL (not an error under ANSI mode) when the label has no variance
        (F.lit(1.0) - F.try_divide(F.col("sse"), F.col("vy") * (F.col("rows") - 1))).alias("r2"),
    )


def _cells(df, label, pred, positive):
    y = _c(label).cast("double") == F.lit(float(positive))
    p = _c(pred).cast("double") == F.lit(float(positive))
    return df.agg(
        F.sum((y & p).cast("long")).alias("tp"),
        F.sum((~y & p).cast("long")).alias("fp"),
        F.sum((~y & ~p).cast("long")).alias("tn"),
        F.sum((y & ~p).cast("long")).alias("fn"),
    )


def _ratio(num, den):
    return F.when(den > 0, num.cast("double") / den)


def auc_hard(df: DataFrame, label: str = "label", pred: str = "prediction",
             positive: float = 1.0) -> DataFrame:
    """Area under the ROC curve of a hard 0/1 prediction = (TPR + TNR) / 2.

    NULL when one class is absent (the curve is undefined).
    """
    c = _cells(df, label, pred, positive)
    tpr = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    tnr = _ratio(F.col("tn"), F.col("tn") + F.col("fp"))
    return c.select(((tpr + tnr) / 2).alias("auc_hard"))


def auc_swapped(df: DataFrame, label: str = "label", pred: str = "prediction",
                positive: float = 1.0) -> DataFrame:
    """The same area with label and prediction exchanged = (PPV + NPV) / 2."""
    c = _cells(df, label, pred, positive)
    ppv = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    npv = _ratio(F.col("tn"), F.col("tn") + F.col("fn"))
    return c.select(((ppv + npv) / 2).alias("auc_swapped"))


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction",
              positive: float = 1.0) -> DataFrame:
    """Confusion counts and ratios in one scan.

    total, correct, wrong, ratio_correct, ratio_wrong; tp, fp, tn, fn counts for
    ``positive``; and the four cells by predicted value as shares of the total:
    pred0_correct, pred1_correct, pred1_wrong, pred0_wrong.
    """
    y, p = _c(label).cast("double"), _c(pred).cast("double")
    pos = F.lit(float(positive))
    ok = y == p
    a = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(ok.cast("long")).alias("correct"),
        F.sum((~ok).cast("long")).alias("wrong"),
        F.sum(((y == pos) & (p == pos)).cast("long")).alias("tp"),
        F.sum(((y != pos) & (p == pos)).cast("long")).alias("fp"),
        F.sum(((y != pos) & (p != pos)).cast("long")).alias("tn"),
        F.sum(((y == pos) & (p != pos)).cast("long")).alias("fn"),
        F.sum(((p == 0.0) & ok).cast("long")).alias("p0c"),
        F.sum(((p == 1.0) & ok).cast("long")).alias("p1c"),
        F.sum(((p == 1.0) & ~ok).cast("long")).alias("p1w"),
        F.sum(((p == 0.0) & ~ok).cast("long")).alias("p0w"),
    )
    t = F.col("total")
    return a.select(
        F.col("total").cast("long").alias("total"),
        F.col("correct").cast("long").alias("correct"),
        F.col("wrong").cast("long").alias("wrong"),
        _ratio(F.col("correct"), t).alias("ratio_correct"),
        _ratio(F.col("wrong"), t).alias("ratio_wrong"),
        F.col("tp").cast("long").alias("tp"),
        F.col("fp").cast("long").alias("fp"),
        F.col("tn").cast("long").alias("tn"),
        F.col("fn").cast("long").alias("fn"),
        _ratio(F.col("p0c"), t).alias("pred0_correct"),
        _ratio(F.col("p1c"), t).alias("pred1_correct"),
        _ratio(F.col("p1w"), t).alias("pred1_wrong"),
        _ratio(F.col("p0w"), t).alias("pred0_wrong"),
    )


def accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    ok = (_c(label).cast("double") == _c(pred).cast("double")).cast("double")
    return df.agg(F.avg(ok).alias("accuracy"), (1 - F.avg(ok)).alias("error_rate"))


def multiclass_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """accuracy, weighted precision / recall / F1 (class weights = label shares).

    One scan: the (label, prediction) cell counts are aggregated first; each
    cell is then credited to its true class and to its predicted class by a
    ``stack`` and re-aggregated per class (at most 2 × classes² rows), so no
    join is needed.
    """
    cells = (df.select(_c(label).cast("double").alias("y"), _c(pred).cast("double").alias("p"))
             .groupBy("y", "p").agg(F.count(F.lit(1)).alias("n")))
    credited = cells.selectExpr(
        "stack(2, y, n, IF(y = p, n, 0L), 0L, p, 0L, 0L, n) AS (k, n_true, tp, n_pred)")
    per = credited.groupBy("k").agg(F.sum("n_true").alias("n_true"), F.sum("tp").alias("tp"),
                                    F.sum("n_pred").alias("n_pred"))
    per = per.filter(F.col("n_true") > 0)
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(F.lit(0.0))
    rec = F.col("tp") / F.col("n_true")
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    per = per.select("n_true", "tp", prec.alias("prec"), rec.alias("rec"), f1.alias("f1"))
    tot = F.sum("n_true")
    return per.agg(
        (F.sum("tp") / tot).alias("accuracy"),
        (F.sum(F.col("prec") * F.col("n_true")) / tot).alias("weighted_precision"),
        (F.sum(F.col("rec") * F.col("n_true")) / tot).alias("weighted_recall"),
        (F.sum(F.col("f1") * F.col("n_true")) / tot).alias("weighted_f1"),
    )


def score_of(col: str, slot: int = 1):
    """A scalar score from a vector column (``rawPrediction``/``probability``) or a number."""
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(col))[slot]


def score_ladder(df: DataFrame, label: str, score, positive: float = 1.0,
                 partitions: int | None = None, keys=(), weight: str | None = None) -> DataFrame:
    """One row per distinct score: (keys), s, pos, neg, pos_below, neg_below, P, N.

    ``pos_below``/``neg_below`` count the rows with a strictly lower score;
    ``P``/``N`` are the class totals.  Every threshold curve (ROC, PR) is a
    function of these columns, so each metric is one aggregate over them.
    ``keys``: a ladder for every value of these columns (models, grid points),
    all from the same passes.  ``weight``: a column with the number of rows that
    a row of ``df`` stands for.

    1. one scan aggregates positives/negatives per distinct score (a score
       shared by a third of all rows is one row from here on);
    2. the distinct scores are range-partitioned by key and score (into
       ``partitions`` parts, default the session's) and written with the number
       of their part, so every later step, also of a re-run task, sees the same
       parts;
    3. per-part totals (a row per part and key: a bounded table) give each
       part's offset; the running count inside a part is a window over that
       part only.  No window ever spans all rows.
    """
    keys = list(keys)
    s = _c(score).cast("double")
    y = _c(label).cast("double") == F.lit(float(positive))
    n = F.lit(1) if weight is None else F.col(weight)
    rows = df.select(*keys, s.alias("s"), y.alias("y"), n.cast("long").alias("n")).filter(F.col("s").isNotNull())
    g = rows.groupBy(*keys, "s").agg(F.sum(F.col("y").cast("long") * F.col("n")).alias("pos"), F.sum((~F.col("y")).cast("long") * F.col("n")).alias("neg"))
    order = [*keys, "s"]
    dealt = g.repartitionByRange(partitions, *order) if partitions else g.repartitionByRange(*order)
    parted = materialized(dealt.withColumn("pid", F.spark_partition_id()), "ladder")
    part = ["pid", *keys]
    totals = parted.groupBy(*part).agg(F.sum("pos").alias("ppos"), F.sum("neg").alias("pneg"))
    of_key = Window.partitionBy(*keys).orderBy("pid")
    before = of_key.rowsBetween(Window.unboundedPreceding, -1)
    everything = of_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One row per part and key: bounded by the parts and keys, safe to broadcast.
    offsets = totals.select(
        *part,
        F.coalesce(F.sum("ppos").over(before), F.lit(0)).alias("off_pos"),
        F.coalesce(F.sum("pneg").over(before), F.lit(0)).alias("off_neg"),
        F.sum("ppos").over(everything).alias("P"),
        F.sum("pneg").over(everything).alias("N"))
    w = Window.partitionBy(*part).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    within = parted.select(
        *part, "s", "pos", "neg",
        F.coalesce(F.sum("pos").over(w), F.lit(0)).alias("in_pos"),
        F.coalesce(F.sum("neg").over(w), F.lit(0)).alias("in_neg"))
    return within.join(F.broadcast(offsets), part).select(
        *keys, "s", "pos", "neg",
        (F.col("off_pos") + F.col("in_pos")).alias("pos_below"),
        (F.col("off_neg") + F.col("in_neg")).alias("neg_below"),
        "P", "N")


def _roc_area():
    return F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)


def _pr_area():
    # Trapezoid between threshold s and the point just above it.  The previous
    # point of every threshold is the count strictly above it, so each
    # trapezoid comes from its own row: no lag across partitions.
    # tp + fp >= 1 at every threshold; only P can be 0 (ANSI: no division by zero).
    P = F.col("P").cast("double")
    tp = P - F.col("pos_below")
    fp = F.col("N") - F.col("neg_below")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    prec = tp / (tp + fp)
    prec0 = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(prec)
    return F.try_divide(tp - tp0, P) * (prec + prec0) / 2.0


def _areas(lad: DataFrame, roc: bool, pr: bool, keys=()) -> DataFrame:
    a = lad.groupBy(*keys).agg(F.sum(_roc_area()).alias("roc"), F.sum(_pr_area()).alias("pr"),
                               F.max("P").alias("P"), F.max("N").alias("N"))
    both = (F.col("P") > 0) & (F.col("N") > 0)
    out = list(keys)
    if roc:
        out.append(F.when(both, F.col("roc") / (F.col("P") * F.col("N"))).alias("auc"))
    if pr:
        out.append(F.when(F.col("P") > 0, F.col("pr")).alias("auc_pr"))
    return a.select(*out)


def curve_areas(df: DataFrame, keys, label: str, score, positive: float = 1.0,
                partitions: int | None = None, weight: str | None = None) -> DataFrame:
    """(keys), ``auc``, ``auc_pr``: exact areas for every value of ``keys``, from one ladder."""
    return _areas(score_ladder(df, label, score, positive, partitions, keys, weight), roc=True, pr=True, keys=keys)


def classifier_metrics(df: DataFrame, keys, label: str = "label", pred: str = "prediction",
                       score="score", positive: float = 1.0) -> DataFrame:
    """(keys), accuracy, error_rate, auc_hard, auc_swapped, auc_score, auc_pr for every value of
    ``keys`` (never NULL): one aggregate for the cells, one ladder for the curves."""
    keys = list(keys)
    y, p = _c(label).cast("double"), _c(pred).cast("double")
    yes, said = y == F.lit(float(positive)), p == F.lit(float(positive))
    cells = df.groupBy(*keys).agg(
        F.avg((y == p).cast("double")).alias("accuracy"),
        *[F.sum(c.cast("long")).alias(n) for n, c in (("tp", yes & said), ("fp", ~yes & said), ("tn", ~yes & ~said), ("fn", yes & ~said))])

    def half(a, b, c, d):
        return (_ratio(F.col(a), F.col(a) + F.col(b)) + _ratio(F.col(c), F.col(c) + F.col(d))) / 2

    hard = cells.select(*keys, "accuracy", (1 - F.col("accuracy")).alias("error_rate"),
                        half("tp", "fn", "tn", "fp").alias("auc_hard"), half("tp", "fp", "tn", "fn").alias("auc_swapped"))
    areas = curve_areas(df, keys, label, score, positive).withColumnRenamed("auc", "auc_score")
    return hard.join(areas, keys, "left")


def exact_auc(df: DataFrame, label: str, score, positive: float = 1.0,
              partitions: int | None = None) -> DataFrame:
    """Exact area under the ROC curve by the rank-sum identity, distributed.

    AUC = Σ_s pos(s) · (neg_below(s) + neg(s)/2) / (P · N) over distinct scores s.
    NULL when one class is absent.
    """
    return _areas(score_ladder(df, label, score, positive, partitions), roc=True, pr=False)


def exact_pr_auc(df: DataFrame, label: str, score, positive: float = 1.0,
                 partitions: int | None = None) -> DataFrame:
    """Exact area under the precision-recall curve, distributed.

    Thresholds are the distinct scores, highest first.  At threshold s the
    counts at or above it are TP = P - pos_below, FP = N - neg_below; the curve
    starts at (recall 0, precision of the first threshold) and consecutive
    points are joined by straight lines (trapezoids), as Spark's
    ``BinaryClassificationMetrics.areaUnderPR`` does without binning.
    NULL when there are no positives.
    """
    return _areas(score_ladder(df, label, score, positive, partitions), roc=False, pr=True)


def exact_curve_areas(df: DataFrame, label: str, score, positive: float = 1.0,
                      partitions: int | None = None) -> DataFrame:
    """``auc`` and ``auc_pr`` from one ladder and one aggregate."""
    return _areas(score_ladder(df, label, score, positive, partitions), roc=True, pr=True)


def auc(df: DataFrame, label: str = "label", score: str = "rawPrediction",
        metric: str = "areaUnderROC", exact: bool = True) -> DataFrame:
    """Area under ROC or PR: exact and distributed when ``exact``, else Spark's
    evaluator (which bins the curve to 1000 points when scores are many)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    dtype = dict(df.dtypes).get(score, "double") if isinstance(score, str) else "double"
    if exact:
        sc = score_of(score) if dtype == "vector" else score
        if metric == "areaUnderROC":
            return exact_auc(df, label, sc)
        if metric == "areaUnderPR":
            return exact_pr_auc(df, label, sc)
    ev = BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label, metricName=metric, numBins=1000)
    value = float(ev.evaluate(df))
    return df.sparkSession.createDataFrame([(metric, value)], "metric string, value double")

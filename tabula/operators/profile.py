"""Aggregations and statistics.  Each function is one scan (one ``agg``) where
Spark allows it, and returns a DataFrame; long-form outputs use ``stack``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _quote(name: str) -> str:
    return name.replace("\\", "\\\\").replace("'", "\\'")


def _stack(cols: list[str], prefix: str) -> str:
    pairs = ", ".join(f"'{_quote(c)}', `{prefix}{i}`" for i, c in enumerate(cols))
    return f"stack({len(cols)}, {pairs})"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                                       T.FloatType, T.DoubleType, T.DecimalType))]


def group_count(df: DataFrame, keys) -> DataFrame:
    """keys + ``count`` (partial aggregate before the shuffle)."""
    return df.groupBy(*([keys] if isinstance(keys, str) else keys)).count()


def group_agg(df: DataFrame, keys, aggs: dict[str, str]) -> DataFrame:
    """keys + ``fn(col)`` per entry of ``aggs`` (Spark's default names, e.g. ``sum(x)``)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    exprs = [getattr(F, fn)(F.col(c)).alias(f"{fn}({c})") for c, fn in aggs.items()]
    return df.groupBy(*keys).agg(*exprs)


def global_stats(df: DataFrame, col: str) -> DataFrame:
    """avg, min, max of one column in a single scan."""
    return df.agg(F.avg(col).alias(f"avg_{col}"), F.min(col).alias(f"min_{col}"),
                  F.max(col).alias(f"max_{col}"))


def describe(df: DataFrame, cols=None, stats=None) -> DataFrame:
    """``summary`` + one string column per input column.

    Default statistics: count, mean, stddev (sample), min, max.  Strings get
    NULL mean/stddev and lexical min/max.
    """
    cols = list(cols) if cols is not None else df.columns
    if stats is None:
        return df.describe(*cols)
    return df.select(*cols).summary(*stats)


def skewness(df: DataFrame, cols) -> DataFrame:
    """column_name, skewness — population skewness, one scan for all columns."""
    cols = list(cols)
    wide = df.agg(*[F.skewness(c).alias(f"__s{i}") for i, c in enumerate(cols)])
    return wide.selectExpr(f"{_stack(cols, '__s')} AS (column_name, skewness)")


def _pearson(a: str, b: str):
    """r from the moments of the rows where both are known; NULL where one is constant
    (Spark's ``corr`` raises there under ANSI mode)."""
    x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(x) * F.stddev_pop(y))


def corr(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson correlation of a pair, one row; NULL if either is constant."""
    return df.agg(_pearson(a, b).alias("corr"))


def cov(df: DataFrame, a: str, b: str) -> DataFrame:
    """Sample covariance of a pair, one row."""
    return df.agg(F.covar_samp(a, b).alias("cov"))


_MOMENTS = ("n", "si", "sj", "qi", "qj", "c")


def moment_matrix(df: DataFrame, cols, sample: int = 1000) -> DataFrame:
    """(i, j, n, si, sj, qi, qj, c) for every pair of columns i < j: the rows where both are
    known, their sums, sums of squares and sum of products.

    One scan whatever the number of columns k: a task keeps five k x k matrices
    (products of the batch's values and of its masks of known values) and emits
    its pairs once, k(k-1)/2 rows, which Spark adds up.  Values are taken
    relative to the means of the first ``sample`` rows, so that columns far
    from zero keep their digits; the results do not depend on that choice.
    """
    cols = list(cols)
    data = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    first = data.limit(sample).agg(*[F.avg(c) for c in data.columns]).first()
    centre = np.array([0.0 if v is None or not np.isfinite(v) else v for v in first])
    k = len(cols)
    upper = np.triu_indices(k, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q, c = (np.zeros((k, k)) for _ in range(4))
        for batch in batches:
            known = np.column_stack([x.is_valid().to_numpy(zero_copy_only=False) for x in batch.columns]).astype(float)
            value = np.column_stack([x.fill_null(0.0).to_numpy() for x in batch.columns]) - centre
            value = np.where(known > 0, value, 0.0)
            n += known.T @ known
            s += value.T @ known  # of the first column, where the second is known
            q += (value * value).T @ known
            c += value.T @ value
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x.astype(np.int32)) for x in upper), *(pa.array(x[upper]) for x in (n, s, s.T, q, q.T, c))], ["i", "j", *_MOMENTS])

    parts = data.mapInArrow(run, "i int, j int, " + ", ".join(f"{m} double" for m in _MOMENTS))
    return parts.groupBy("i", "j").agg(*[F.sum(m).alias(m) for m in _MOMENTS])


def corr_matrix(df: DataFrame, cols=None) -> DataFrame:
    """Long form (a, b, r) for every pair a < b (input order), from one ``moment_matrix`` scan.

    ``r`` covers the rows where both are known and is NULL where a column is
    constant there; such pairs never count as correlated.
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")

    def spread(q: str, s: str):
        out = F.col(q) - F.col(s) * F.col(s) / F.col("n")
        return F.when(out > 1e-12 * F.col(q), out)  # what rounding leaves of a constant is none

    pairs = moment_matrix(df, cols).filter("n > 0")
    r = (F.col("c") - F.col("si") * F.col("sj") / F.col("n")) / F.sqrt(spread("qi", "si") * spread("qj", "sj"))
    names = F.array(*[F.lit(c) for c in cols])
    found = pairs.select("i", "j", F.when(F.abs(r) > 1, F.signum(r)).otherwise(r).alias("r"))
    every = df.sparkSession.range(len(cols)).select(F.col("id").cast("int").alias("i"))
    every = every.select("i", F.explode(F.sequence(F.lit(0), F.lit(len(cols) - 1))).alias("j")).filter("i < j")
    return every.join(found, ["i", "j"], "left").select(names[F.col("i")].alias("a"), names[F.col("j")].alias("b"), "r")


def correlated_pairs(df: DataFrame, cols=None, threshold: float = 0.9) -> DataFrame:
    """Pairs whose |r| reaches ``threshold``."""
    return corr_matrix(df, cols).filter(F.abs(F.col("r")) >= threshold)


def drop_correlated(df: DataFrame, cols=None, threshold: float = 0.9):
    """Drop the second column of every highly correlated pair.

    Returns ``(pruned_df, dropped_names)``.  Only the pair list (bounded by
    k², k = number of columns) reaches the driver.
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    place = {c: i for i, c in enumerate(cols)}
    pairs = sorted(correlated_pairs(df, cols, threshold).collect(), key=lambda row: (place[row.a], place[row.b]))
    dropped: list[str] = []
    for row in pairs:
        if row.a not in dropped and row.b not in dropped:
            dropped.append(row.b)
    return df.drop(*dropped), dropped


def cardinality(df: DataFrame, cols, exact: bool = True, rsd: float = 0.01) -> DataFrame:
    """column_name, distinct_count (of known values).

    Exact: one scan and one plan of fixed size for any number of columns.  Every
    task drops the repeats of all its columns (a partial aggregate on column and
    value), so a value held by a third of the rows leaves it once; the sets merge
    by hash of column and value, and a column's distinct values are counted in
    as many parts as the shuffle has.  Columns are told apart by their place,
    values by their text.  ``exact=False``: HyperLogLog++ for all columns in one scan.
    """
    cols = list(cols)
    if not exact:
        wide = df.agg(*[F.approx_count_distinct(c, rsd).alias(f"__d{i}") for i, c in enumerate(cols)])
        return (wide.selectExpr(f"{_stack(cols, '__d')} AS (column_name, distinct_count)")
                .withColumn("distinct_count", F.col("distinct_count").cast("long")))
    types = dict(df.dtypes)

    def text(c: str):
        col = F.col(f"`{c}`")
        if types[c] in ("float", "double"):
            col = col + F.lit(0).cast(types[c])  # the two zeros are one value
        return F.hex(col) if types[c] == "binary" else col.cast("string")

    held = F.explode(F.array(*[F.struct(F.lit(i).alias("place"), text(c).alias("value")) for i, c in enumerate(cols)])).alias("x")
    distinct = df.select(held).select("x.place", "x.value").filter("value IS NOT NULL").distinct()
    counted = distinct.groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    names = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in cols])).alias("place", "column_name"))
    return names.join(counted, "place", "left").select("column_name", F.coalesce("n", F.lit(0)).cast("long").alias("distinct_count"))


def high_cardinality(df: DataFrame, cols, max_distinct: int, exact: bool = True, rsd: float = 0.01) -> DataFrame:
    """Columns with more than ``max_distinct`` values (candidates to leave out).

    Exact: a sketch of all columns in one scan first rules out those clearly
    below the limit (by ten times its error); only the others are counted.
    """
    cols = list(cols)
    if exact and len(cols) > 1:
        sketched = cardinality(df, cols, exact=False, rsd=rsd).collect()
        cols = [r["column_name"] for r in sketched if r["distinct_count"] > max_distinct * (1 - 10 * rsd)] or cols[:1]
    return cardinality(df, cols, exact, rsd).filter(F.col("distinct_count") > max_distinct)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """class, n, share, fraction — fraction = n_min / n, the down-sampling rate that
    balances every class to the smallest one.

    One lazy plan: the counts are aggregated on the executors, and a window over
    the class table (one row per class) adds the totals.
    """
    counts = df.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()
    return counts.select(
        "class",
        F.col("n").cast("long").alias("n"),
        (F.col("n") / F.sum("n").over(every)).alias("share"),
        (F.min("n").over(every) / F.col("n")).alias("fraction"),
    )

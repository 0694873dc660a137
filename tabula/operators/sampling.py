"""Sampling, splitting, stratification and fold assignment.

All hash-based forms are a filter or projection on ``hash_unit(keys, seed)``:
no shuffle, no driver round trip, and the same rows are chosen whatever the
partitioning or after a task is re-run.  Rows sharing a key move together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import SPACE, cumulative_thresholds, hash_unit, threshold


def sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Bernoulli sample without replacement (Spark's own; depends on partitioning).
    ``fraction >= 1`` returns the frame unchanged."""
    if fraction >= 1.0:
        return df
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, keys, fraction: float, seed: int = 42) -> DataFrame:
    """Repeatable sample: rows whose hash unit is below ``fraction`` of the space."""
    if fraction >= 1.0:
        return df
    return df.filter(hash_unit(keys, seed) < F.lit(threshold(fraction)))


def split_index(keys, weights, seed: int = 42) -> Column:
    """int part number 0..len(weights)-1 for each row."""
    h = hash_unit(keys, seed)
    cuts = cumulative_thresholds(weights)
    expr = None
    for i, cut in enumerate(cuts[:-1]):
        cond = h < F.lit(cut)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    last = F.lit(len(cuts) - 1)
    return last if expr is None else expr.otherwise(last)


def hash_split(df: DataFrame, keys, weights, seed: int = 42) -> list[DataFrame]:
    """Disjoint, complete parts in proportion to ``weights``."""
    h = hash_unit(keys, seed)
    cuts = cumulative_thresholds(weights)
    parts, lo = [], 0
    for hi in cuts:
        conds = ([h >= F.lit(lo)] if lo > 0 else []) + ([h < F.lit(hi)] if hi < SPACE else [])
        if not conds:
            parts.append(df)
        elif len(conds) == 1:
            parts.append(df.filter(conds[0]))
        else:
            parts.append(df.filter(h.between(F.lit(lo), F.lit(hi - 1))))
        lo = hi
    return parts


def with_split(df: DataFrame, keys, weights, seed: int = 42, col: str = "split") -> DataFrame:
    return df.withColumn(col, split_index(keys, weights, seed))


def stratified_sample(df: DataFrame, label: str, fractions: dict, keys, seed: int = 42) -> DataFrame:
    """Keep each class at its own rate; a class missing from ``fractions`` is dropped
    (rate 0), as ``sampleBy`` does.  The per-class cut point is chosen first, so
    the row hash is computed once: ``h < cut(label)``."""
    cut = None
    for cls, frac in fractions.items():
        cond = F.col(label) == F.lit(cls)
        t = F.lit(threshold(frac))
        cut = F.when(cond, t) if cut is None else cut.when(cond, t)
    if cut is None:
        return df.limit(0)
    return df.filter(hash_unit(keys, seed) < cut.otherwise(F.lit(-1)))


def fold_index(keys, k: int, seed: int = 42) -> Column:
    """int fold 0..k-1, uniform over keys."""
    return ((hash_unit(keys, seed) * F.lit(k)) / F.lit(SPACE)).cast("long").cast("int")


def with_folds(df: DataFrame, keys, k: int = 3, seed: int = 42, col: str = "fold") -> DataFrame:
    """Adds a fold column usable as ``CrossValidator(foldCol=...)``."""
    return df.withColumn(col, fold_index(keys, k, seed))

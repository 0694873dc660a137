"""Chart-ready aggregates: the data behind line, bar, pie and scatter displays."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import SPACE, hash_unit
from ..session import materialized
from .profile import _stack


def _measure(fn: str, value: str | None):
    if fn == "count" or value is None:
        return F.count(F.lit(1))
    return getattr(F, fn)(F.col(value))


def line_data(df: DataFrame, key: str, value: str, fn: str = "sum") -> DataFrame:
    """key, ``<fn>_<value>`` per key, ordered by key."""
    return (df.groupBy(key).agg(_measure(fn, value).alias(f"{fn}_{value}"))
            .orderBy(key))


def bar_data(df: DataFrame, cat: str, value: str | None = None, fn: str = "count",
             top: int | None = None, by: str | None = None) -> DataFrame:
    """Category frequency (or ``fn(value)``), optionally split by a second key ``by``;
    ``top`` keeps the k largest bars (ties broken by category)."""
    name = "n" if fn == "count" else f"{fn}_{value}"
    keys = [cat] + ([by] if by else [])
    out = df.groupBy(*keys).agg(_measure(fn, value).alias(name))
    ordered = out.orderBy(F.desc(name), *[F.asc(k) for k in keys])
    return ordered.limit(top) if top else ordered


def long_stats(df: DataFrame, cols, fn: str = "sum") -> DataFrame:
    """column_name, value: one statistic per column (pie/dashboard data), one scan."""
    cols = list(cols)
    wide = df.agg(*[getattr(F, fn)(F.col(c)).cast("double").alias(f"__v{i}")
                    for i, c in enumerate(cols)])
    return wide.selectExpr(f"{_stack(cols, '__v')} AS (column_name, value)")


def scatter_data(df: DataFrame, cols, n: int, key, seed: int = 42) -> DataFrame:
    """A bounded, repeatable sample of ``n`` rows: the n smallest hash units.

    The number of rows (a count that reads no column of a Parquet table) gives a
    bound on the hash below which some more than ``n`` rows are expected; only
    those are kept, by a filter inside the scan, and ordered.  So the last task
    gets about ``n`` rows whatever the number of input parts.  Should the bound
    leave too few (six deviations), or keys repeat, all rows are ordered.
    """
    keys = [key] if isinstance(key, str) else list(key)
    base = df.select(*keys, *[c for c in cols if c not in keys], hash_unit(keys, seed).alias("__h"))
    rows = df.count()
    expected = n + 6 * math.sqrt(n) + 20
    few = base
    if rows > expected:
        some = materialized(base.filter(F.col("__h") < int(SPACE * expected / rows)), "scatter")
        if some.count() >= n:
            few = some
    return few.orderBy("__h", *keys).limit(n).drop("__h")


def peak_keys(df: DataFrame, key: str, value: str, k: int = 3, desc: bool = True,
              fn: str = "sum") -> DataFrame:
    """The k keys with the highest (or lowest) ``fn(value)``; ties by key."""
    name = f"{fn}_{value}"
    agg = df.groupBy(key).agg(_measure(fn, value).alias(name))
    order = F.desc(name) if desc else F.asc(name)
    return agg.orderBy(order, F.asc(key)).limit(k)

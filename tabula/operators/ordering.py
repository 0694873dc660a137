"""Sort and bounded top-n."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_desc(df: DataFrame, col: str, *tiebreak: str) -> DataFrame:
    """Range-partitioned global sort, descending on ``col``."""
    return df.orderBy(F.desc(col), *[F.asc(t) for t in tiebreak])


def top_n(df: DataFrame, n: int, order) -> DataFrame:
    """First ``n`` rows under a total order (``TakeOrderedAndProject``: no full sort)."""
    order = list(order) if isinstance(order, (list, tuple)) else [order]
    return df.orderBy(*order).limit(n)

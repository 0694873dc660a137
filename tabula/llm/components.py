"""Connected components of a link table, by alternating star contractions.

Large star hangs every larger neighbour of a node on the smallest node it
knows, small star does so for the smaller ones; repeated, each component
becomes a star around its smallest id.  Rounds grow with the logarithm of a
component's size.  All of it is groupings and equi-joins on the link table;
each round is written to the shared folder, and only its row count and a hash
of its rows reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_scratch


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; component is the smallest id reachable."""
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = write_scratch(links.select(u, v).filter("u <> v").distinct(), "links")
    seen = _state(now)
    while seen[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").select("u", "v", "m")
        small = hung.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v").filter("u <> v").distinct()
        now = write_scratch(small, "links")
        was, seen = seen, _state(now)
        if seen == was:
            break
    roots = now.select(F.col("v").alias("u"), "v").distinct()
    return now.unionAll(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))

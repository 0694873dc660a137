"""Feature-encoding stages (Spark ML transformers/estimators), built from roles."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.columns import Roles
from ..session import materialized


def string_index(cols, out_cols=None, order: str = "frequencyDesc",
                 invalid: str = "keep") -> StringIndexer:
    """One multi-column indexer: a single fit pass counts every column.

    ``frequencyDesc`` orders by descending count with ties alphabetical;
    ``invalid='keep'`` gives unseen values and NULL their own last index
    instead of failing at scoring time.  A fitted indexer holds its labels on
    the driver; for columns with as many values as rows take ``dictionary``.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    out_cols = out_cols or [f"idx_{c}" for c in cols]
    if len(cols) == 1:
        return StringIndexer(inputCol=cols[0], outputCol=out_cols[0],
                             stringOrderType=order, handleInvalid=invalid)
    return StringIndexer(inputCols=cols, outputCols=out_cols,
                         stringOrderType=order, handleInvalid=invalid)


def dictionary(df: DataFrame, col: str, order: str = "frequencyDesc") -> DataFrame:
    """(value, n, code) of a column: the codes ``string_index`` would give, as a table.

    The values are counted, range-partitioned in the order of the codes and
    written; a code is the value's place in its part and the number of values
    in the parts before.  One row a part is all that is ever brought together.
    ``order``: ``frequencyDesc`` (ties alphabetical) or ``alphabetAsc``.
    """
    ranks = {"frequencyDesc": [F.col("n").desc(), F.col("value").asc()], "alphabetAsc": [F.col("value").asc()]}[order]
    counted = df.select(F.col(f"`{col}`").cast("string").alias("value")).filter("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    dealt = counted.repartitionByRange(*ranks).sortWithinPartitions(*ranks)
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # the row's number in its part
    placed = materialized(dealt.withColumn("part", F.spark_partition_id()).withColumn("place", place), "dictionary")
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size")).select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return placed.join(parts, "part").select("value", "n", (F.col("before") + F.col("place")).alias("code"))


def encode(df: DataFrame, cols, dictionaries: dict[str, DataFrame] | None = None, order: str = "frequencyDesc",
           prefix: str = "idx_") -> DataFrame:
    """Add ``<prefix><column>`` (double) by joins with dictionaries, made from ``df`` unless given.

    Unseen values and NULL get the number of known values, a code of their own.
    A value that many rows hold is a skewed join that Spark splits; small
    dictionaries are broadcast by their measured size.
    """
    out = df
    for col in [cols] if isinstance(cols, str) else list(cols):
        known = (dictionaries or {}).get(col)
        known = dictionary(df, col, order) if known is None else known
        codes = known.select(F.col("value").alias("__value"), F.col("code").alias("__code"))
        size = known.count()
        joined = out.join(codes, F.col(f"`{col}`").cast("string") == F.col("__value"), "left")
        out = joined.withColumn(f"{prefix}{col}", F.coalesce("__code", F.lit(size)).cast("double")).drop("__value", "__code")
    return out


def one_hot(cols, out_cols=None, drop_last: bool = True, invalid: str = "keep") -> OneHotEncoder:
    cols = [cols] if isinstance(cols, str) else list(cols)
    out_cols = out_cols or [f"{c}_Vector" for c in cols]
    return OneHotEncoder(inputCols=cols, outputCols=out_cols, dropLast=drop_last,
                         handleInvalid=invalid)


def assemble(cols, out: str = "features", invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=invalid)


def scale(col: str = "features_assembler", out: str = "features", with_mean: bool = False,
          with_std: bool = True) -> StandardScaler:
    """Divide by the sample standard deviation; no centring by default (keeps sparsity)."""
    return StandardScaler(inputCol=col, outputCol=out, withMean=with_mean, withStd=with_std)


def feature_columns(roles: Roles, encode: str = "onehot") -> list[str]:
    """Assembler inputs for the roles: encoded categoricals then numerics.

    ``encode``: ``onehot`` (index → one-hot vector), ``index`` (the index as a
    nominal number, for trees) or ``none`` (categoricals left out).
    """
    if encode == "onehot":
        cats = [roles.vector_name(c) for c in roles.categorical]
    elif encode == "index":
        cats = [roles.index_name(c) for c in roles.categorical]
    else:
        cats = []
    return cats + list(roles.numeric)


"""Null handling: blanks to NULL, literal replacement, row drops, a one-pass null report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .profile import _stack


def _string_columns(df: DataFrame, cols=None) -> list[str]:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return names if cols is None else [c for c in cols if c in names]


def blank_to_null(df: DataFrame, cols=None) -> DataFrame:
    """'' → NULL in string columns only; other types are untouched."""
    targets = set(_string_columns(df, cols))
    return df.select([
        F.when(F.col(c) == "", F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
        if c in targets else F.col(c)
        for c in df.columns
    ])


def replace_value(df: DataFrame, old, new, cols=None) -> DataFrame:
    """Replace a value by another *value* (e.g. '' → 'null' stays a string, not NULL)."""
    return df.replace(old, new, subset=cols)


def drop_nulls(df: DataFrame, subset=None, how: str = "any") -> DataFrame:
    """Drop rows with NULL (in ``subset`` when given)."""
    return df.na.drop(how=how, subset=subset)


def null_report(df: DataFrame, cols=None) -> DataFrame:
    """column, nulls, rows, any_null — one scan for all columns, then unpivot."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    # names are taken literally, dots and quotes included
    aggs += [F.sum(df[f"`{c.replace('`', '``')}`"].isNull().cast("long")).alias(f"__n{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    long = wide.selectExpr("__rows", f"{_stack(cols, '__n')} AS (column_name, nulls)")
    return long.select(
        "column_name",
        F.coalesce(F.col("nulls"), F.lit(0)).cast("long").alias("nulls"),
        F.col("__rows").cast("long").alias("rows"),
        (F.coalesce(F.col("nulls"), F.lit(0)) > 0).alias("any_null"),
    )

"""Projection, renames, column roles and code mapping (metadata + native expressions)."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.codes import code_label
from .profile import high_cardinality

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def select_where(df: DataFrame, pred: Callable[[str], bool]) -> DataFrame:
    """Keep the columns whose *name* satisfies ``pred`` (in input order)."""
    return df.select([c for c in df.columns if pred(c)])


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns; names that do not exist are ignored."""
    return df.drop(*list(names))


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def map_codes(df: DataFrame, col: str, mapping: dict, default=None,
              out: str | None = None) -> DataFrame:
    """Replace (or add as ``out``) a column by its code → label mapping."""
    return df.withColumn(out or col, code_label(col, mapping, default))


@dataclass(frozen=True)
class Roles:
    """Column roles: categorical and numeric features, label, ids."""

    categorical: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    label: str | None = None
    ids: tuple[str, ...] = field(default_factory=tuple)

    @property
    def features(self) -> tuple[str, ...]:
        return self.categorical + self.numeric

    def index_name(self, c: str) -> str:
        return f"idx_{c}"

    def vector_name(self, c: str) -> str:
        return f"{c}_Vector"


def infer_roles(df: DataFrame, cat_prefix: str | None = None, cont_prefix: str | None = None,
                label: str | None = None, exclude: Iterable[str] = (),
                ids: Iterable[str] = (), max_distinct: int | None = None) -> Roles:
    """Roles by name prefix when prefixes are given, otherwise by data type.

    Strings/booleans are categorical, numbers numeric; label, ids and
    ``exclude`` are never features.  ``max_distinct`` leaves out categorical
    columns with more values (one scan): an indexer collects every distinct
    value of its columns, so free text must not become a category.
    """
    skip = set(exclude) | set(ids) | ({label} if label else set())
    cats, nums = [], []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if cat_prefix or cont_prefix:
            if cat_prefix and f.name.startswith(cat_prefix):
                cats.append(f.name)
            elif cont_prefix and f.name.startswith(cont_prefix):
                nums.append(f.name)
        elif isinstance(f.dataType, (T.StringType, T.BooleanType)):
            cats.append(f.name)
        elif isinstance(f.dataType, _NUMERIC):
            nums.append(f.name)
    if max_distinct is not None and cats:
        wide = {r["column_name"] for r in high_cardinality(df, cats, max_distinct).collect()}
        cats = [c for c in cats if c not in wide]
    return Roles(tuple(cats), tuple(nums), label, tuple(ids))


_ROLE_SCHEMA = T.StructType([
    T.StructField("position", T.LongType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("role", T.StringType(), False),
    T.StructField("index_column", T.StringType(), True),
    T.StructField("vector_column", T.StringType(), True),
])


def roles_table(df: DataFrame, roles: Roles) -> DataFrame:
    """One row per input column: role and derived encoder column names."""
    rows = []
    for i, c in enumerate(df.columns):
        if c in roles.categorical:
            rows.append((i + 1, c, "categorical", roles.index_name(c), roles.vector_name(c)))
        elif c in roles.numeric:
            rows.append((i + 1, c, "numeric", None, None))
        elif c == roles.label:
            rows.append((i + 1, c, "label", None, None))
        elif c in roles.ids:
            rows.append((i + 1, c, "id", None, None))
        else:
            rows.append((i + 1, c, "ignored", None, None))
    return df.sparkSession.createDataFrame(rows, _ROLE_SCHEMA)

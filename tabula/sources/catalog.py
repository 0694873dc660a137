"""Session catalog helpers: caching, views, file listing, schema as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def materialize(df: DataFrame) -> DataFrame:
    """Cache and fill the cache with one pass; the frame is reused afterwards.

    Cached blocks lost with an executor are recomputed from lineage, so this is
    safe under executor loss.  Call ``unpersist()`` when the reuse is over.
    """
    df = df.cache()
    df.count()
    return df


def register(df: DataFrame, name: str) -> DataFrame:
    """Session-scoped SQL view (names resolve case-insensitively)."""
    df.createOrReplaceTempView(name)
    return df


def cache_view(spark: SparkSession, name: str, eager: bool = False) -> bool:
    """Cache a registered view; returns ``isCached``."""
    spark.catalog.cacheTable(name)
    if eager:
        spark.table(name).count()
    return spark.catalog.isCached(name)


def list_files(spark: SparkSession, path_glob: str, recursive: bool = False) -> DataFrame:
    """path, length, modification time of the files matched; content is never read."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return (reader.load(path_glob)
            .select("path", "length", F.col("modificationTime").alias("modification_time")))


_SCHEMA_TABLE = T.StructType([
    T.StructField("position", T.LongType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("data_type", T.StringType(), False),
    T.StructField("nullable", T.BooleanType(), False),
])


def schema_table(df: DataFrame) -> DataFrame:
    """The schema as rows (metadata only: as many rows as columns)."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, _SCHEMA_TABLE)

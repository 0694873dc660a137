"""Table sources: CSV with a declared or inferred schema, other built-in formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The 20-field churn layout (names, types, order) as declared by the
# workload.  Field 19 carries the file's "Customer service calls" column; it is
# named for what it holds.  Columns bind by position, not by header name.
CHURN_SCHEMA = T.StructType([
    T.StructField("state_code", T.StringType(), True),
    T.StructField("account_length", T.IntegerType(), True),
    T.StructField("area_code", T.StringType(), True),
    T.StructField("international_plan", T.StringType(), True),
    T.StructField("voice_mail_plan", T.StringType(), True),
    T.StructField("num_voice_mail", T.DoubleType(), True),
    T.StructField("total_day_mins", T.DoubleType(), True),
    T.StructField("total_day_calls", T.DoubleType(), True),
    T.StructField("total_day_charge", T.DoubleType(), True),
    T.StructField("total_evening_mins", T.DoubleType(), True),
    T.StructField("total_evening_calls", T.DoubleType(), True),
    T.StructField("total_evening_charge", T.DoubleType(), True),
    T.StructField("total_night_mins", T.DoubleType(), True),
    T.StructField("total_night_calls", T.DoubleType(), True),
    T.StructField("total_night_charge", T.DoubleType(), True),
    T.StructField("total_international_mins", T.DoubleType(), True),
    T.StructField("total_international_calls", T.DoubleType(), True),
    T.StructField("total_international_charge", T.DoubleType(), True),
    T.StructField("customer_service_calls", T.DoubleType(), True),
    T.StructField("churn", T.StringType(), True),
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, null_value: str | None = None,
             infer_schema: bool | None = None, **options) -> DataFrame:
    """CSV scan.

    With ``schema`` the columns bind by position and no inference pass runs
    (the right choice at scale).  Without it the schema is inferred, which
    costs one extra pass over the input.
    """
    reader = spark.read.format("csv").option("header", header)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if schema is not None:
        reader = reader.schema(schema)
        # Positional binding: a header whose names differ is not an error.
        reader = reader.option("enforceSchema", True)
    else:
        reader = reader.option("inferSchema", True if infer_schema is None else infer_schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Any built-in format: parquet, orc, json, csv, text, libsvm, image, binaryFile."""
    if fmt == "csv":
        return read_csv(spark, path, schema=schema, **options)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)

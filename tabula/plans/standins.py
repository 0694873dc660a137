"""Workload frames derived from the shared test tables.

The three workloads (hourly demand regression, claim-cost regression, churn
classification) ship no data here, so each is re-expressed over a given
table with the same roles.  Every derivation is a projection (plus one
fixture join for churn) that Catalyst prunes and pushes into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import Roles


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# event_type → weather code used by the demand stand-in.
EVENT_WEATHER = {"view": 1, "click": 2, "purchase": 3, "signup": 4}


def bike_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly demand from ``events``: hour/day parts of ``ts``, ``cnt`` = ``value``."""
    ev = _t(spark, sf_dir, "events")
    wd = F.dayofweek("ts")
    weather = None
    for k, v in EVENT_WEATHER.items():
        cond = F.col("event_type") == k
        weather = F.when(cond, F.lit(v)) if weather is None else weather.when(cond, F.lit(v))
    return ev.select(
        F.col("event_id").alias("instant"),
        F.to_date("ts").alias("dteday"),
        F.least(F.lit(4), F.ceil(F.dayofmonth("ts") / 8)).cast("int").alias("season"),
        (F.year("ts") % 2).cast("int").alias("yr"),
        F.month("ts").alias("mnth"),
        F.hour("ts").alias("hr"),
        wd.alias("weekday"),
        F.when(wd.isin(1, 7), F.lit(0)).otherwise(F.lit(1)).alias("workingday"),
        weather.alias("weathersit"),
        (F.minute("ts") / 60.0).alias("atemp"),
        (F.get_json_object("props", "$.k").cast("double") / 100.0).alias("hum"),
        ((F.col("user_id") % 67) / 67.0).alias("windspeed"),
        F.col("value").alias("cnt"),
    )


BIKE_ROLES = Roles(categorical=("season", "yr", "workingday", "weathersit"),
                   numeric=("mnth", "hr", "atemp", "hum", "windspeed"),
                   label="cnt", ids=("instant",))

# the same with the codes mapped to their labels
BIKE_LABEL_ROLES = Roles(categorical=("season_label", "yr", "workingday", "weather_label"),
                         numeric=("mnth", "hr", "atemp", "hum", "windspeed"),
                         label="cnt", ids=("instant",))


def claims_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claim cost from ``lineitem``: ``cat*`` strings, ``cont*`` doubles, ``loss``."""
    li = _t(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.col("l_returnflag").alias("cat1"),
        F.col("l_linestatus").alias("cat2"),
        F.col("l_quantity").alias("cont1"),
        F.col("l_discount").alias("cont2"),
        F.col("l_tax").alias("cont3"),
        F.col("l_extendedprice").alias("loss"),
    )


CLAIMS_KEYS = ("l_orderkey", "l_linenumber")


def churn_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Churn from ``labels`` ⋈ ``documents``: minority class (quality 0) is "True".

    Only four narrow document columns are read; the join strategy is left to
    AQE (both sides grow with the data, so no forced broadcast).
    """
    lab = _t(spark, sf_dir, "labels")
    docs = _t(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return lab.join(docs, "doc_id").select(
        "doc_id", "lang", "source",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.col("toxic").cast("double").alias("toxic"),
        F.when(F.col("quality") == 0, F.lit("True")).otherwise(F.lit("False")).alias("churn"),
    )


CHURN_ROLES = Roles(categorical=("lang", "source"), numeric=("n_chars", "toxic"),
                    label="churn", ids=("doc_id",))


def churn_orders_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Larger churn variant from ``orders``: label = status 'F'."""
    o = _t(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        "o_orderpriority",
        F.col("o_totalprice").alias("totalprice"),
        F.year("o_orderdate").cast("double").alias("order_year"),
        F.month("o_orderdate").cast("double").alias("order_month"),
        F.when(F.col("o_orderstatus") == "F", F.lit("True")).otherwise(F.lit("False")).alias("churn"),
    )


CHURN_ORDERS_ROLES = Roles(categorical=("o_orderpriority",),
                           numeric=("totalprice", "order_year", "order_month"),
                           label="churn", ids=("o_orderkey",))


# The churn file's own header names, in file order (they differ
# from the declared names; a declared schema binds by position).
CHURN_FILE_HEADER = (
    "State", "Account length", "Area code", "International plan", "Voice mail plan",
    "Number vmail messages", "Total day minutes", "Total day calls", "Total day charge",
    "Total eve minutes", "Total eve calls", "Total eve charge", "Total night minutes",
    "Total night calls", "Total night charge", "Total intl minutes", "Total intl calls",
    "Total intl charge", "Customer service calls", "Churn",
)


def churn_file_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A churn-shaped 20-column frame from ``lineitem``, named as the churn file
    names its columns; ``Number vmail messages`` is missing on line 7 of each
    order (written as the file's ``NA`` token)."""
    li = _t(spark, sf_dir, "lineitem")
    yes_no = lambda cond: F.when(cond, F.lit("yes")).otherwise(F.lit("no"))
    cols = [
        F.col("l_returnflag"),
        F.col("l_linenumber"),
        F.col("l_linestatus"),
        yes_no(F.col("l_discount") > 0.05),
        yes_no(F.col("l_tax") > 0.04),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity")),
        F.col("l_extendedprice"),
        F.col("l_quantity"),
        F.col("l_discount"),
        F.col("l_tax"),
        F.col("l_orderkey").cast("double"),
        F.col("l_partkey").cast("double"),
        F.col("l_suppkey").cast("double"),
        F.col("l_linenumber").cast("double"),
        F.col("l_tax"),
        F.col("l_discount"),
        F.col("l_quantity"),
        F.col("l_extendedprice"),
        F.col("l_linenumber").cast("double"),
        F.when(F.col("l_returnflag") == "R", F.lit("True")).otherwise(F.lit("False")),
    ]
    return li.select(*[c.alias(n) for c, n in zip(cols, CHURN_FILE_HEADER)])

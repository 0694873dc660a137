"""Registered queries: one per operator, each over whole given tables, each
paired (where SQL can express it) with the DuckDB text that must give the
same rows.  Computed columns carry the same alias on both sides; doubles are
rounded on both sides because addition order differs between engines;
integers are BIGINT on both sides; timestamps travel as strings.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import SEASON_CODES, SEASON_DEFAULT, WEATHER_CODES, WEATHER_DEFAULT
from ..functions.hashing import threshold
from ..operators import charts, cleaning, columns, evaluate, ordering, profile, sampling
from ..session import scratch_path
from ..sources import catalog as cat
from ..sources import readers, sinks
from . import features, jobs, models, standins

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return wrap


def T(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r(c, d: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


# ---------------------------------------------------------------- shared SQL

BIKE_CTE = """
bike AS (
  SELECT event_id AS instant,
         CAST(least(4, ceil(day(ts) / 8.0)) AS INTEGER) AS season,
         CAST(year(ts) % 2 AS INTEGER) AS yr,
         CAST(month(ts) AS INTEGER) AS mnth,
         CAST(hour(ts) AS INTEGER) AS hr,
         CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday,
         CASE WHEN dayofweek(ts) IN (0, 6) THEN 0 ELSE 1 END AS workingday,
         CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2
                         WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 END AS weathersit,
         minute(ts) / 60.0::DOUBLE AS atemp,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0::DOUBLE AS hum,
         (user_id % 67) / 67.0::DOUBLE AS windspeed,
         value AS cnt
  FROM events)
"""

CHURN_CTE = """
churn_t AS (
  SELECT l.doc_id, d.lang, d.source, CAST(d.n_chars AS DOUBLE) AS n_chars,
         CAST(l.toxic AS DOUBLE) AS toxic,
         CASE WHEN l.quality = 0 THEN 'True' ELSE 'False' END AS churn
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
"""

# deterministic label / prediction / score over lineitem for the evaluation operators
PRED_CTE = """
pred AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
         CASE WHEN l_quantity > 30 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction,
         (l_quantity + l_discount)::DOUBLE AS score,
         l_extendedprice AS y, (l_quantity * 2000.0)::DOUBLE AS yhat
  FROM lineitem)
"""


def pred_frame(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"),
        F.when(F.col("l_quantity") > 30, 1.0).otherwise(0.0).alias("prediction"),
        (F.col("l_quantity") + F.col("l_discount")).alias("score"),
        F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * 2000.0).alias("yhat"),
    )


def hsql(key_sql: str, seed: int) -> str:
    return f"('0x' || substr(md5(coalesce(CAST({key_sql} AS VARCHAR), '\\N') || ':{seed}'), 1, 8))::BIGINT"


def hsql2(k1: str, k2: str, seed: int) -> str:
    parts = ", ".join(f"coalesce(CAST({k} AS VARCHAR), '\\N')" for k in (k1, k2))
    return f"('0x' || substr(md5(concat_ws('|', {parts}) || ':{seed}'), 1, 8))::BIGINT"


ORDERS_COLS_SQL = """o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority"""


def _orders_out(df):
    return df.select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"),
        F.col("o_custkey").cast("long").alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
        "o_orderpriority",
    )


# ================================================================ 2.1 sources

@query("s1_csv_inferred_schema", f"SELECT {ORDERS_COLS_SQL} FROM orders")
def s1(spark, sf_dir):
    path = scratch_path(spark, "s1-orders-csv")
    T(spark, sf_dir, "orders").write.option("header", True).csv(path)
    return _orders_out(readers.read_csv(spark, path))


@query("s2_csv_format_alias", """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
FROM customer""")
def s2(spark, sf_dir):
    path = scratch_path(spark, "s2-customer-csv")
    T(spark, sf_dir, "customer").write.option("header", True).csv(path)
    df = readers.read_table(spark, path, "com.databricks.spark.csv", header=True, inferSchema=True)
    return df.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name",
                     F.col("c_nationkey").cast("long").alias("c_nationkey"),
                     F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_mktsegment")


@query("s3_csv_declared_schema_null_token", """
SELECT o_orderkey AS okey, o_custkey AS ckey, o_orderstatus AS status, o_totalprice AS price,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS priority
FROM orders""")
def s3(spark, sf_dir):
    # Written with the file's own header names and 'NA' for missing priorities;
    # read back under a declared schema whose names differ: binding is positional.
    path = scratch_path(spark, "s3-orders-csv")
    src = T(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_orderpriority"))
        .alias("o_orderpriority"))
    src.write.option("header", True).option("nullValue", "NA").csv(path)
    schema = "okey BIGINT, ckey BIGINT, status STRING, price DOUBLE, priority STRING"
    return readers.read_csv(spark, path, schema=schema, null_value="NA")


LINEITEM_SQL = """l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate"""


def _lineitem_out(df):
    return df.select(*[c for c in df.columns if c not in ("l_linenumber", "l_shipdate")],
                     F.col("l_linenumber").cast("long").alias("l_linenumber"),
                     F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("l_shipdate"))


@query("s5_orc_roundtrip", f"SELECT {LINEITEM_SQL} FROM lineitem")
def s5_orc(spark, sf_dir):
    path = scratch_path(spark, "s5-lineitem-orc")
    _lineitem_out(T(spark, sf_dir, "lineitem")).write.orc(path)
    return readers.read_table(spark, path, "orc")


@query("s5_json_roundtrip", f"SELECT {ORDERS_COLS_SQL} FROM orders")
def s5_json(spark, sf_dir):
    path = scratch_path(spark, "s5-orders-json")
    _orders_out(T(spark, sf_dir, "orders")).write.json(path)
    schema = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate STRING, o_orderpriority STRING")
    return readers.read_table(spark, path, "json", schema=schema)


_S4_SQL = """
SELECT l_returnflag AS state_code, l_linenumber AS account_length, l_linestatus AS area_code,
       CASE WHEN l_discount > 0.05 THEN 'yes' ELSE 'no' END AS international_plan,
       CASE WHEN l_tax > 0.04 THEN 'yes' ELSE 'no' END AS voice_mail_plan,
       CASE WHEN l_linenumber <> 7 THEN l_quantity END AS num_voice_mail,
       l_extendedprice AS total_day_mins, l_quantity AS total_day_calls, l_discount AS total_day_charge,
       l_tax AS total_evening_mins, CAST(l_orderkey AS DOUBLE) AS total_evening_calls,
       CAST(l_partkey AS DOUBLE) AS total_evening_charge, CAST(l_suppkey AS DOUBLE) AS total_night_mins,
       CAST(l_linenumber AS DOUBLE) AS total_night_calls, l_tax AS total_night_charge,
       l_discount AS total_international_mins, l_quantity AS total_international_calls,
       l_extendedprice AS total_international_charge, CAST(l_linenumber AS DOUBLE) AS customer_service_calls,
       CASE WHEN l_returnflag = 'R' THEN 'True' ELSE 'False' END AS churn
FROM lineitem"""


@query("s4_declared_churn_schema", _S4_SQL)
def s4(spark, sf_dir):
    # The file keeps its own header names and 'NA' tokens; the declared
    # 20-field schema binds by position and turns 'NA' into NULL.
    path = scratch_path(spark, "s4-churn-csv")
    (standins.churn_file_frame(spark, sf_dir).write.option("header", True)
     .option("nullValue", "NA").csv(path))
    return readers.read_csv(spark, path, schema=readers.CHURN_SCHEMA, null_value="NA")


@query("s5_text_roundtrip", """
SELECT concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus,
                 CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR),
                 strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_orderpriority) AS value,
       o_orderkey, o_orderpriority FROM orders""")
def s5_text(spark, sf_dir):
    path = scratch_path(spark, "s5-orders-text")
    o = T(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("long").cast("string")
    o.select(F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus", cents,
                         F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), "o_orderpriority").alias("value")).write.text(path)
    lines = readers.read_table(spark, path, "text")
    parts = F.split("value", r"\|")
    return lines.select("value", parts[0].cast("long").alias("o_orderkey"), parts[5].alias("o_orderpriority"))


_LINEITEM_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                     "l_discount", "l_tax"]


@query("s5_libsvm_roundtrip", "SELECT CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE AS label, "
       + ", ".join(f"{c}::DOUBLE AS f{i}" for i, c in enumerate(_LINEITEM_NUMBERS)) + " FROM lineitem")
def s5_libsvm(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    path = scratch_path(spark, "s5-lineitem-libsvm")
    li = T(spark, sf_dir, "lineitem").withColumn("label", F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0))
    features.assemble(_LINEITEM_NUMBERS, "features").transform(li) \
        .select("label", "features").write.format("libsvm").save(path)
    # numFeatures given: no extra pass to find the widest row
    back = readers.read_table(spark, path, "libsvm", numFeatures=len(_LINEITEM_NUMBERS))
    a = vector_to_array("features")
    return back.select("label", *[a[i].alias(f"f{i}") for i in range(len(_LINEITEM_NUMBERS))])


@query("s6_materialize", f"SELECT {LINEITEM_SQL} FROM lineitem")
def s6(spark, sf_dir):
    return _lineitem_out(cat.materialize(T(spark, sf_dir, "lineitem")))


@query("s8_cache_view", """
SELECT o_orderstatus, round(sum(o_totalprice), 2) AS total_price, count(*)::BIGINT AS n
FROM orders GROUP BY o_orderstatus""")
def s8(spark, sf_dir):
    cat.register(T(spark, sf_dir, "orders"), "orders_cached_view")
    cat.cache_view(spark, "orders_cached_view")
    return spark.sql("""SELECT o_orderstatus, round(sum(o_totalprice), 2) AS total_price,
                        count(*) AS n FROM orders_cached_view GROUP BY o_orderstatus""")


@query("s9_list_files")
def s9(spark, sf_dir):
    return cat.list_files(spark, f"{sf_dir}/*.parquet")


@query("s10_write_metrics", f"""
WITH {PRED_CTE.strip()},
c AS (SELECT count(*) AS total, sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS correct FROM pred)
SELECT 'eval' AS run, 'fixed_rule' AS model, metric, round(value, 6) AS value FROM (
  SELECT 'total' AS metric, total::DOUBLE AS value FROM c
  UNION ALL SELECT 'correct', correct::DOUBLE FROM c
  UNION ALL SELECT 'ratio_correct', correct::DOUBLE / total FROM c)""")
def s10(spark, sf_dir):
    wide = evaluate.confusion(pred_frame(spark, sf_dir)).select("total", "correct", "ratio_correct")
    long = jobs.metrics_long("eval", "fixed_rule", wide)
    path = scratch_path(spark, "s10-metrics")
    sinks.write_metrics(long, path, mode="append")
    back = sinks.read_metrics(spark, path)
    return back.select("run", "model", "metric", r("value").alias("value"))


@query("s11_model_save_load", "SELECT o_orderkey, true AS same FROM orders")
def s11(spark, sf_dir):
    df = standins.churn_orders_frame(spark, sf_dir)
    est = models.estimator("tree", maxDepth=4)
    model = models.fit(models.build_pipeline(standins.CHURN_ORDERS_ROLES, est, encode="index",
                                             label_source="churn"), df)
    path = scratch_path(spark, "s11-model")
    sinks.save_model(model, path)
    # the rows scored once are scored again by the reloaded model: one scan, no join
    once = model.transform(df).select(*df.columns, F.col("prediction").alias("first"))
    twice = sinks.load_model(path).transform(once)
    return twice.select("o_orderkey", (F.col("first") == F.col("prediction")).alias("same"))


_S12_TYPES = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
              "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
              "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}


@query("s12_schema_table", "\nUNION ALL ".join(
    f"SELECT {i + 1}::BIGINT AS position, '{c}' AS column_name, '{t}' AS data_type, count(*) - count({c}) AS nulls,"
    f" count(*) AS rows FROM lineitem" for i, (c, t) in enumerate(_S12_TYPES.items())))
def s12(spark, sf_dir):
    # the declared schema beside what the rows hold
    df = T(spark, sf_dir, "lineitem")
    return (cat.schema_table(df).join(cleaning.null_report(df), "column_name")
            .select("position", "column_name", "data_type", "nulls", "rows"))


# ================================================================ 2.2 projections

@query("p1_select_reorder", "SELECT l_returnflag, l_quantity, l_orderkey FROM lineitem")
def p1(spark, sf_dir):
    return T(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_orderkey")


@query("p2_drop_columns", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, l_quantity,
       l_extendedprice, l_discount, l_returnflag, l_linestatus FROM lineitem""")
def p2(spark, sf_dir):
    df = columns.drop_columns(T(spark, sf_dir, "lineitem"), ["l_tax", "l_shipdate", "no_such"])
    return df.withColumn("l_linenumber", F.col("l_linenumber").cast("long"))


@query("p3_rename_label", "SELECT l_orderkey, l_quantity, l_extendedprice AS loss FROM lineitem")
def p3(spark, sf_dir):
    df = T(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    return columns.rename(df, {"l_extendedprice": "loss"})


@query("p4_select_by_name", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem")
def p4(spark, sf_dir):
    return columns.select_where(T(spark, sf_dir, "lineitem"), lambda c: c.endswith("key"))


@query("p5_infer_roles", """
SELECT l_returnflag, l_linestatus, l_partkey, l_suppkey, l_quantity, l_discount, l_tax,
       l_extendedprice AS label, l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM lineitem""")
def p5(spark, sf_dir):
    # the roles found in the table, applied to it: features, label, ids
    df = T(spark, sf_dir, "lineitem")
    roles = columns.infer_roles(df, label="l_extendedprice", ids=["l_orderkey", "l_linenumber"], max_distinct=100)
    return df.select(*roles.features, F.col(roles.label).alias("label"), *[F.col(c).cast("long").alias(c) for c in roles.ids])


_P6_SQL = f"""
WITH {BIKE_CTE.strip()}
SELECT instant, weathersit,
  CASE weathersit WHEN 1 THEN 'Clear' WHEN 2 THEN 'Mist' WHEN 3 THEN 'Light Rain-Snow'
       ELSE 'Heavy Rain' END AS weather_label,
  season,
  CASE season WHEN 1 THEN 'spring' WHEN 2 THEN 'summer' WHEN 3 THEN 'fall'
       ELSE 'winter' END AS season_label
FROM bike"""


def _p6_frame(spark, sf_dir):
    df = standins.bike_frame(spark, sf_dir)
    df = columns.map_codes(df, "weathersit", WEATHER_CODES, WEATHER_DEFAULT, out="weather_label")
    df = columns.map_codes(df, "season", SEASON_CODES, SEASON_DEFAULT, out="season_label")
    return df.select("instant", "weathersit", "weather_label", "season", "season_label")


@query("p6_map_codes", _P6_SQL)
def p6(spark, sf_dir):
    return _p6_frame(spark, sf_dir)


@query("p7_filter_not_equal", f"SELECT * FROM ({_P6_SQL}) WHERE weather_label <> 'Clear'")
def p7(spark, sf_dir):
    return _p6_frame(spark, sf_dir).filter(F.col("weather_label") != "Clear")


@query("p8_filter_is_null", f"WITH {BIKE_CTE.strip()} SELECT instant, cnt FROM bike WHERE weathersit IS NULL")
def p8(spark, sf_dir):
    return (standins.bike_frame(spark, sf_dir).filter(F.col("weathersit").isNull())
            .select("instant", "cnt"))


@query("p9_filter_column_compare", f"""
WITH {PRED_CTE.strip()}
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, label, prediction FROM pred
WHERE label = prediction AND prediction = 1.0""")
def p9(spark, sf_dir):
    df = pred_frame(spark, sf_dir)
    out = df.filter(F.col("label") == F.col("prediction")).filter(F.col("prediction") == 1.0)
    return out.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
                      "label", "prediction")


@query("p10_sql_where", """
SELECT l_orderkey, l_quantity, l_discount, l_returnflag FROM lineitem
WHERE l_returnflag = 'R' AND l_discount > 0.04""")
def p10(spark, sf_dir):
    cat.register(T(spark, sf_dir, "lineitem"), "Lineitem_View")
    return spark.sql("""SELECT l_orderkey, l_quantity, l_discount, l_returnflag
                        FROM lineitem_view WHERE l_returnflag = 'R' AND l_discount > 0.04""")


@query("p11_arithmetic_over_aggregates", """
SELECT l_returnflag, round((sum(l_tax) + sum(l_discount)) / count(*), 6) AS avg_tax_plus_discount,
       round(sum(l_extendedprice) / sum(l_quantity), 6) AS price_per_unit
FROM lineitem GROUP BY l_returnflag""")
def p11(spark, sf_dir):
    df = T(spark, sf_dir, "lineitem")
    return df.groupBy("l_returnflag").agg(
        r((F.sum("l_tax") + F.sum("l_discount")) / F.count(F.lit(1))).alias("avg_tax_plus_discount"),
        r(F.sum("l_extendedprice") / F.sum("l_quantity")).alias("price_per_unit"))


_BIKE_MAPPED_SQL = f"""
WITH {BIKE_CTE.strip()},
demand_labels AS (
  SELECT instant,
         CASE season WHEN 1 THEN 'spring' WHEN 2 THEN 'summer' WHEN 3 THEN 'fall' ELSE 'winter' END AS season,
         yr, mnth, hr, weekday, workingday,
         CASE weathersit WHEN 1 THEN 'Clear' WHEN 2 THEN 'Mist' WHEN 3 THEN 'Light Rain-Snow'
              ELSE 'Heavy Rain' END AS weathersit,
         atemp, hum, windspeed, cnt
  FROM bike)"""


def _bike_mapped(spark, sf_dir):
    """The demand frame with both code columns replaced by their labels, as a named view."""
    df = standins.bike_frame(spark, sf_dir).drop("dteday")
    df = columns.map_codes(df, "season", SEASON_CODES, SEASON_DEFAULT)
    df = columns.map_codes(df, "weathersit", WEATHER_CODES, WEATHER_DEFAULT)
    return cat.register(df, "Demand_Labels")


# The season and the wind speed that the demand workload's query asks for.
_WINDY = ("summer", 0.4)


@query("p10_bike_sql_where", f"""{_BIKE_MAPPED_SQL.strip()}
SELECT * FROM demand_labels WHERE season = '{_WINDY[0]}' AND windspeed > {_WINDY[1]}""")
def p10b(spark, sf_dir):
    _bike_mapped(spark, sf_dir)
    season, wind = _WINDY
    return spark.sql("SELECT * FROM demand_labels WHERE season = :season AND windspeed > :wind", args={"season": season, "wind": wind})


@query("p7_bike_season_not_spring", f"""{_BIKE_MAPPED_SQL.strip()}
SELECT * FROM demand_labels WHERE season <> 'spring'""")
def p7b(spark, sf_dir):
    df = _bike_mapped(spark, sf_dir)
    return df.filter(df.season != "spring")


@query("a4_bike_sql_season_max", f"""{_BIKE_MAPPED_SQL.strip()}
SELECT season, max(cnt) AS max_cnt FROM demand_labels GROUP BY season""")
def a4b(spark, sf_dir):
    return spark.sql("SELECT season, max(cnt) AS max_cnt FROM {view} GROUP BY season", view=_bike_mapped(spark, sf_dir))


# ================================================================ 2.3 cleaning

_BLANK_SQL = """CASE WHEN l_linenumber = 1 THEN '' ELSE l_returnflag END"""


def _with_blanks(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
                     F.when(F.col("l_linenumber") == 1, F.lit("")).otherwise(F.col("l_returnflag"))
                     .alias("flag"), "l_quantity")


@query("c1_blank_to_null", f"""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, nullif({_BLANK_SQL}, '') AS flag, l_quantity
FROM lineitem""")
def c1(spark, sf_dir):
    return cleaning.blank_to_null(_with_blanks(spark, sf_dir))


@query("c2_replace_value", f"""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
       CASE WHEN l_linenumber = 1 THEN 'null' ELSE l_returnflag END AS flag, l_quantity
FROM lineitem""")
def c2(spark, sf_dir):
    return cleaning.replace_value(_with_blanks(spark, sf_dir), "", "null", cols=["flag"])


@query("c3_drop_nulls_subset", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_returnflag AS flag, l_quantity
FROM lineitem WHERE l_linenumber <> 1""")
def c3(spark, sf_dir):
    return cleaning.drop_nulls(cleaning.blank_to_null(_with_blanks(spark, sf_dir)), subset=["flag"])


@query("c4_drop_nulls_any", f"WITH {BIKE_CTE.strip()} SELECT * FROM bike WHERE weathersit IS NOT NULL")
def c4(spark, sf_dir):
    return cleaning.drop_nulls(standins.bike_frame(spark, sf_dir).drop("dteday"))


_C5_COLS = ["instant", "season", "yr", "mnth", "hr", "weekday", "workingday", "weathersit", "atemp", "hum", "windspeed", "cnt"]


@query("c5_null_report", f"WITH {BIKE_CTE.strip()}\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, (count(*) - count({c}))::BIGINT AS nulls, count(*)::BIGINT AS rows,"
    f" count(*) > count({c}) AS any_null FROM bike" for c in _C5_COLS))
def c5(spark, sf_dir):
    return cleaning.null_report(standins.bike_frame(spark, sf_dir).drop("dteday"))


# ================================================================ 2.4 aggregations

@query("a1_count_after_filter", "SELECT count(*)::BIGINT AS n FROM lineitem WHERE l_returnflag <> 'N'")
def a1(spark, sf_dir):
    return (T(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") != "N")
            .agg(F.count(F.lit(1)).alias("n")))


@query("a2_group_count", """
SELECT l_returnflag, l_linestatus, count(*)::BIGINT AS count FROM lineitem GROUP BY 1, 2""")
def a2(spark, sf_dir):
    return profile.group_count(T(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("a3_group_sum", """
SELECT l_returnflag, round(sum(l_tax), 4) AS "sum(l_tax)" FROM lineitem GROUP BY 1""")
def a3(spark, sf_dir):
    out = profile.group_agg(T(spark, sf_dir, "lineitem"), "l_returnflag", {"l_tax": "sum"})
    return out.withColumn("sum(l_tax)", r("`sum(l_tax)`", 4))


@query("a4_sql_group_max", """
SELECT l_linestatus, max(l_quantity) AS max_qty FROM lineitem GROUP BY l_linestatus""")
def a4(spark, sf_dir):
    cat.register(T(spark, sf_dir, "lineitem"), "lineitem_a4")
    return spark.sql("SELECT l_linestatus, max(l_quantity) AS max_qty FROM lineitem_a4 GROUP BY l_linestatus")


@query("a5_sql_group_sum_alias", """
SELECT o_orderstatus, round(SUM(o_totalprice), 2) AS total_price FROM orders GROUP BY o_orderstatus""")
def a5(spark, sf_dir):
    cat.register(T(spark, sf_dir, "orders"), "orders_a5")
    return spark.sql("""SELECT o_orderstatus, round(SUM(o_totalprice), 2) AS total_price
                        FROM orders_a5 GROUP BY o_orderstatus""")


A6_SQL = """
SELECT l_returnflag,
       round(SUM(l_quantity), 2) AS qty, round(SUM(l_extendedprice), 2) AS price,
       round(SUM(l_discount), 4) AS discount, round(SUM(l_tax), 4) AS tax,
       round(SUM(l_quantity) + SUM(l_extendedprice) + SUM(l_discount) + SUM(l_tax), 2) AS total
FROM lineitem GROUP BY l_returnflag ORDER BY total DESC"""


def a6_frame(li: DataFrame) -> DataFrame:
    """Sums per class, a derived total of the sums, ordered by the total (descending)."""
    cat.register(li, "lineitem_a6")
    return li.sparkSession.sql("""
        SELECT l_returnflag,
               round(SUM(l_quantity), 2) AS qty, round(SUM(l_extendedprice), 2) AS price,
               round(SUM(l_discount), 4) AS discount, round(SUM(l_tax), 4) AS tax,
               round(SUM(l_quantity) + SUM(l_extendedprice) + SUM(l_discount) + SUM(l_tax), 2) AS total
        FROM lineitem_a6 GROUP BY l_returnflag ORDER BY total DESC""")


@query("a6_sums_total_order_desc", A6_SQL)
def a6(spark, sf_dir):
    return a6_frame(T(spark, sf_dir, "lineitem"))


@query("a7_sum_of_sums", """
SELECT o_orderpriority, round(SUM(o_totalprice) + SUM(o_custkey), 2) AS total FROM orders GROUP BY 1""")
def a7(spark, sf_dir):
    cat.register(T(spark, sf_dir, "orders"), "orders_a7")
    return spark.sql("""SELECT o_orderpriority, round(SUM(o_totalprice) + SUM(o_custkey), 2) AS total
                        FROM orders_a7 GROUP BY o_orderpriority""")


@query("a8_global_avg_min_max", """
SELECT round(avg(l_extendedprice), 4) AS avg_l_extendedprice, min(l_extendedprice) AS min_l_extendedprice,
       max(l_extendedprice) AS max_l_extendedprice FROM lineitem""")
def a8(spark, sf_dir):
    out = profile.global_stats(T(spark, sf_dir, "lineitem"), "l_extendedprice")
    return out.withColumn("avg_l_extendedprice", r("avg_l_extendedprice", 4))


def _describe_sql(cols, table):
    parts = []
    for stat, fn in [("count", "count({c})::DOUBLE"), ("mean", "round(avg({c}), 6) + 0.0"),
                     ("stddev", "round(stddev_samp({c}), 6) + 0.0"), ("min", "round(min({c}), 6) + 0.0"),
                     ("max", "round(max({c}), 6) + 0.0")]:
        sel = ", ".join(f"{fn.format(c=c)} AS {c}" for c in cols)
        parts.append(f"SELECT '{stat}' AS summary, {sel} FROM {table}")
    return "\nUNION ALL ".join(parts)


_A9_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_as_double(df, cols):
    return df.select("summary", *[r(F.expr(f"try_cast(`{c}` AS DOUBLE)")).alias(c) for c in cols])


@query("a9_describe", _describe_sql(_A9_COLS, "lineitem"))
def a9(spark, sf_dir):
    d = profile.describe(T(spark, sf_dir, "lineitem"), _A9_COLS)
    return _describe_as_double(d, _A9_COLS)


@query("a10_describe_projection", """
SELECT summary, l_quantity, l_returnflag FROM (
  SELECT 'count' AS summary, count(l_quantity)::DOUBLE AS l_quantity, count(l_returnflag)::DOUBLE AS l_returnflag FROM lineitem
  UNION ALL SELECT 'mean', round(avg(l_quantity), 6), NULL FROM lineitem
  UNION ALL SELECT 'stddev', round(stddev_samp(l_quantity), 6), NULL FROM lineitem
  UNION ALL SELECT 'min', min(l_quantity), NULL FROM lineitem
  UNION ALL SELECT 'max', max(l_quantity), NULL FROM lineitem)""")
def a10(spark, sf_dir):
    d = profile.describe(T(spark, sf_dir, "lineitem"))
    return _describe_as_double(d.select("summary", "l_quantity", "l_returnflag"),
                               ["l_quantity", "l_returnflag"])


def _skew_sql(c, table):
    return (f"SELECT '{c}' AS column_name, round(avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5), 6)"
            f" AS skewness FROM {table}, (SELECT avg({c}) AS m FROM {table})")


@query("a11_skewness", "\nUNION ALL ".join(_skew_sql(c, "lineitem") for c in _A9_COLS))
def a11(spark, sf_dir):
    return profile.skewness(T(spark, sf_dir, "lineitem"), _A9_COLS).withColumn("skewness", r("skewness"))


@query("a12_corr_pair", "SELECT round(corr(l_quantity, l_extendedprice), 6) AS corr FROM lineitem")
def a12(spark, sf_dir):
    return profile.corr(T(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice").select(r("corr").alias("corr"))


@query("a13_covariance", "SELECT round(covar_samp(l_quantity, l_extendedprice), 4) AS cov FROM lineitem")
def a13(spark, sf_dir):
    return profile.cov(T(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice").select(r("cov", 4).alias("cov"))


def _pairs_sql(cols, table, where=""):
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS r FROM {table}")
    body = "\nUNION ALL ".join(parts)
    return f"SELECT * FROM ({body}) {where}"


@query("a14_corr_matrix", _pairs_sql(_LINEITEM_NUMBERS, "lineitem"))
def a14(spark, sf_dir):
    return profile.corr_matrix(T(spark, sf_dir, "lineitem")).withColumn("r", r("r") + 0.0)


_WIDE = 100


@query("a14_corr_wide", f"""
WITH u AS (SELECT p_partkey, i, CASE WHEN p_partkey % (13 + i) <> 0 THEN ((p_partkey * (2 * i + 1) + p_size * (i % 7)) % (11 + i))::DOUBLE END AS v
           FROM part, range({_WIDE}) AS t(i))
SELECT 'v' || a.i AS a, 'v' || b.i AS b, round(corr(a.v, b.v), 6) + 0.0 AS r
FROM u a JOIN u b ON a.p_partkey = b.p_partkey AND a.i < b.i GROUP BY a.i, b.i""")
def a14w(spark, sf_dir):
    # a hundred numbers of every part, each missing in other rows
    def number(i):
        value = (F.col("p_partkey") * (2 * i + 1) + F.col("p_size") * (i % 7)) % (11 + i)
        return F.when(F.col("p_partkey") % (13 + i) != 0, value.cast("double")).alias(f"v{i}")

    wide = T(spark, sf_dir, "part").select(*[number(i) for i in range(_WIDE)])
    return profile.corr_matrix(wide).withColumn("r", r("r") + 0.0)


_A15_SQL_COLS = """l_quantity, l_extendedprice, l_extendedprice * (1 - l_discount) AS net_price, l_tax"""
_A15_COLS = ["l_quantity", "l_extendedprice", "net_price", "l_tax"]


def _a15_frame(spark, sf_dir):
    # a price and the same price after discount: a pair like minutes and charges
    li = T(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                     (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price"), "l_tax")


@query("a15_correlated_pairs", _pairs_sql(_A15_COLS, f"(SELECT {_A15_SQL_COLS} FROM lineitem)",
                                          "WHERE abs(r) >= 0.9"))
def a15(spark, sf_dir):
    return (profile.correlated_pairs(_a15_frame(spark, sf_dir), _A15_COLS, 0.9)
            .withColumn("r", r("r") + 0.0))


@query("a15_drop_correlated", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity, l_extendedprice, l_tax FROM lineitem""")
def a15b(spark, sf_dir):
    pruned, _ = profile.drop_correlated(_a15_frame(spark, sf_dir), _A15_COLS, 0.9)
    return pruned.withColumn("l_linenumber", F.col("l_linenumber").cast("long"))


@query("a16_cardinality", """
SELECT 'p_name' AS column_name, count(DISTINCT p_name)::BIGINT AS distinct_count FROM part
UNION ALL SELECT 'p_brand', count(DISTINCT p_brand)::BIGINT FROM part
UNION ALL SELECT 'p_type', count(DISTINCT p_type)::BIGINT FROM part
UNION ALL SELECT 'p_size', count(DISTINCT p_size)::BIGINT FROM part""")
def a16(spark, sf_dir):
    return profile.cardinality(T(spark, sf_dir, "part"), ["p_name", "p_brand", "p_type", "p_size"])


_EVERY = {"part": "p_partkey p_name p_brand p_type p_size p_retailprice",
          "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"}


@query("a16_cardinality_all", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(DISTINCT {c})::BIGINT AS distinct_count FROM {t}" for t, cs in _EVERY.items() for c in cs.split()))
def a16a(spark, sf_dir):
    # every column of both tables, each table in one scan
    found = [profile.cardinality(T(spark, sf_dir, t), cs.split()).select(F.lit(t).alias("table_name"), "*") for t, cs in _EVERY.items()]
    return reduce(DataFrame.unionByName, found)


@query("a16_high_cardinality", """
SELECT * FROM (
  SELECT 'p_name' AS column_name, count(DISTINCT p_name)::BIGINT AS distinct_count FROM part
  UNION ALL SELECT 'p_brand', count(DISTINCT p_brand)::BIGINT FROM part
  UNION ALL SELECT 'p_type', count(DISTINCT p_type)::BIGINT FROM part) WHERE distinct_count > 30""")
def a16b(spark, sf_dir):
    return profile.high_cardinality(T(spark, sf_dir, "part"), ["p_name", "p_brand", "p_type"], 30)


@query("a17_class_balance", f"""
WITH {CHURN_CTE.strip()},
c AS (SELECT churn AS class, count(*) AS n FROM churn_t GROUP BY churn)
SELECT class, n::BIGINT AS n, round(n::DOUBLE / (SELECT sum(n) FROM c), 6) AS share,
       round((SELECT min(n) FROM c)::DOUBLE / n, 6) AS fraction FROM c""")
def a17(spark, sf_dir):
    out = profile.class_balance(standins.churn_frame(spark, sf_dir), "churn")
    return out.withColumn("share", r("share")).withColumn("fraction", r("fraction"))


# ================================================================ 2.5 chart data

@query("d1_line_data", f"""
WITH {BIKE_CTE.strip()} SELECT hr, round(sum(cnt), 4) AS sum_cnt FROM bike GROUP BY hr""")
def d1(spark, sf_dir):
    return charts.line_data(standins.bike_frame(spark, sf_dir), "hr", "cnt").withColumn("sum_cnt", r("sum_cnt", 4))


@query("d2_bar_data", """
SELECT l_returnflag, l_linestatus, count(*)::BIGINT AS n FROM lineitem GROUP BY 1, 2
ORDER BY n DESC, l_returnflag, l_linestatus LIMIT 3""")
def d2(spark, sf_dir):
    return charts.bar_data(T(spark, sf_dir, "lineitem"), "l_returnflag", by="l_linestatus", top=3)


@query("d3_long_stats", """
SELECT 'l_quantity' AS column_name, round(sum(l_quantity), 2) AS value FROM lineitem
UNION ALL SELECT 'l_extendedprice', round(sum(l_extendedprice), 2) FROM lineitem
UNION ALL SELECT 'l_discount', round(sum(l_discount), 2) FROM lineitem
UNION ALL SELECT 'l_tax', round(sum(l_tax), 2) FROM lineitem""")
def d3(spark, sf_dir):
    return charts.long_stats(T(spark, sf_dir, "lineitem"), _A9_COLS).withColumn("value", r("value", 2))


@query("d4_scatter_sample", f"""
SELECT o_orderkey, o_totalprice, o_custkey FROM orders
ORDER BY {hsql('o_orderkey', 42)}, o_orderkey LIMIT 200""")
def d4(spark, sf_dir):
    return charts.scatter_data(T(spark, sf_dir, "orders"), ["o_totalprice", "o_custkey"], 200, "o_orderkey", 42)


@query("d5_peak_hours_high", f"""
WITH {BIKE_CTE.strip()}
SELECT hr, round(sum(cnt), 4) AS sum_cnt FROM bike GROUP BY hr ORDER BY sum(cnt) DESC, hr LIMIT 3""")
def d5a(spark, sf_dir):
    return charts.peak_keys(standins.bike_frame(spark, sf_dir), "hr", "cnt", 3, True).withColumn("sum_cnt", r("sum_cnt", 4))


@query("d5_peak_hours_low", f"""
WITH {BIKE_CTE.strip()}
SELECT hr, round(sum(cnt), 4) AS sum_cnt FROM bike GROUP BY hr ORDER BY sum(cnt) ASC, hr LIMIT 3""")
def d5b(spark, sf_dir):
    return charts.peak_keys(standins.bike_frame(spark, sf_dir), "hr", "cnt", 3, False).withColumn("sum_cnt", r("sum_cnt", 4))


@query("d5_season_totals", f"""
WITH {BIKE_CTE.strip()}
SELECT CASE season WHEN 1 THEN 'spring' WHEN 2 THEN 'summer' WHEN 3 THEN 'fall' ELSE 'winter' END AS season_label,
       round(sum(cnt), 4) AS sum_cnt FROM bike GROUP BY 1""")
def d5c(spark, sf_dir):
    df = columns.map_codes(standins.bike_frame(spark, sf_dir), "season", SEASON_CODES, SEASON_DEFAULT,
                           out="season_label")
    return charts.peak_keys(df, "season_label", "cnt", 4).withColumn("sum_cnt", r("sum_cnt", 4))


@query("d5_workingday_totals", f"""
WITH {BIKE_CTE.strip()}
SELECT workingday, round(sum(cnt), 4) AS sum_cnt, round(avg(cnt), 6) AS avg_cnt FROM bike GROUP BY 1""")
def d5d(spark, sf_dir):
    df = standins.bike_frame(spark, sf_dir)
    return df.groupBy("workingday").agg(r(F.sum("cnt"), 4).alias("sum_cnt"), r(F.avg("cnt")).alias("avg_cnt"))


# ================================================================ 2.6 sort / limit

@query("o1_sort_desc", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def o1(spark, sf_dir):
    return ordering.sort_desc(T(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"),
                              "o_totalprice", "o_orderkey")


@query("o2_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def o2(spark, sf_dir):
    return ordering.top_n(T(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 10,
                          [F.desc("o_totalprice"), F.asc("o_orderkey")])


# ================================================================ 2.7 sampling

@query("m1_bernoulli_sample")
def m1(spark, sf_dir):
    return sampling.sample(T(spark, sf_dir, "orders").select("o_orderkey"), 0.15, seed=42)


@query("m1_sample_share", """
SELECT count(*)::BIGINT AS n, true AS within_bounds, 0::BIGINT AS strangers, true AS repeats FROM orders""")
def m1s(spark, sf_dir):
    # six deviations of a fair draw; all drawn rows are the table's; the same seed draws the same rows
    rows = T(spark, sf_dir, "orders").select("o_orderkey")
    drawn = sampling.sample(rows, 0.15, seed=42)
    again = sampling.sample(rows, 0.15, seed=42).agg(F.count(F.lit(1)).alias("k2"), F.sum(F.xxhash64("o_orderkey").cast("decimal(38,0)")).alias("h2"))
    one = drawn.agg(F.count(F.lit(1)).alias("k"), F.sum(F.xxhash64("o_orderkey").cast("decimal(38,0)")).alias("h"))
    strangers = drawn.join(rows, "o_orderkey", "left_anti").agg(F.count(F.lit(1)).alias("strangers"))
    total = rows.agg(F.count(F.lit(1)).alias("n"))
    every = reduce(lambda a, b: a.withColumn("_1", F.lit(1)).join(b.withColumn("_1", F.lit(1)), "_1").drop("_1"), [total, one, again, strangers])
    bound = F.abs(F.col("k") - 0.15 * F.col("n")) <= 6 * F.sqrt(0.15 * 0.85 * F.col("n"))
    return every.select("n", bound.alias("within_bounds"), "strangers", ((F.col("k") == F.col("k2")) & (F.col("h") == F.col("h2"))).alias("repeats"))


@query("m2_hash_sample", f"""
SELECT o_orderkey, o_totalprice FROM orders WHERE {hsql('o_orderkey', 42)} < {threshold(0.15)}""")
def m2(spark, sf_dir):
    return sampling.hash_sample(T(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"),
                                "o_orderkey", 0.15, seed=42)


@query("m3_hash_split_70_30", f"""
SELECT o_orderkey, CASE WHEN {hsql('o_orderkey', 42)} < {threshold(0.7)} THEN 0 ELSE 1 END AS split FROM orders""")
def m3(spark, sf_dir):
    df = T(spark, sf_dir, "orders").select("o_orderkey")
    train, test = sampling.hash_split(df, "o_orderkey", [0.7, 0.3], seed=42)
    return (train.withColumn("split", F.lit(0))).unionByName(test.withColumn("split", F.lit(1)))


@query("m3_hash_split_75_25_composite_key", f"""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
       CASE WHEN {hsql2('l_orderkey', 'l_linenumber', 12345)} < {threshold(0.75)} THEN 0 ELSE 1 END AS split
FROM lineitem""")
def m3b(spark, sf_dir):
    df = T(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long"))
    return sampling.with_split(df, ["l_orderkey", "l_linenumber"], [0.75, 0.25], seed=12345)


@query("m4_stratified_sample", f"""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_returnflag FROM lineitem
WHERE (l_returnflag = 'A' AND {hsql2('l_orderkey', 'l_linenumber', 12345)} < {threshold(0.5)})
   OR (l_returnflag = 'N' AND {hsql2('l_orderkey', 'l_linenumber', 12345)} < {threshold(0.1703)})""")
def m4(spark, sf_dir):
    df = T(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long"), "l_returnflag")
    # class 'R' is not listed: rate 0
    return sampling.stratified_sample(df, "l_returnflag", {"A": 0.5, "N": 0.1703},
                                      ["l_orderkey", "l_linenumber"], seed=12345)


@query("m5_fold_assignment", f"""
SELECT o_orderkey, (({hsql('o_orderkey', 42)}) * 3 // 4294967296)::INTEGER AS fold FROM orders""")
def m5(spark, sf_dir):
    return sampling.with_folds(T(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 3, seed=42)


_NULLED = "(SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS k, o_custkey, o_orderstatus, o_orderkey FROM orders)"


def _nulled(spark, sf_dir):
    """Orders with a key that is NULL in every third row."""
    return T(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey")).alias("k"), "o_custkey", "o_orderstatus", "o_orderkey")


@query("m2_hash_sample_null_keys", f"SELECT o_orderkey FROM {_NULLED} WHERE {hsql('k', 42)} < {threshold(0.6)}")
def m2n(spark, sf_dir):
    return sampling.hash_sample(_nulled(spark, sf_dir), "k", 0.6, seed=42).select("o_orderkey")


@query("m3_hash_split_null_keys", f"""
SELECT o_orderkey, CASE WHEN {hsql2('k', 'o_custkey', 42)} < {threshold(0.7)} THEN 0 ELSE 1 END AS split FROM {_NULLED}""")
def m3n(spark, sf_dir):
    parts = sampling.hash_split(_nulled(spark, sf_dir), ["k", "o_custkey"], [0.7, 0.3], seed=42)
    return reduce(DataFrame.unionByName, [p.select("o_orderkey", F.lit(i).alias("split")) for i, p in enumerate(parts)])


@query("m4_stratified_null_keys", f"""
SELECT o_orderkey, o_orderstatus FROM {_NULLED}
WHERE {hsql2('k', 'o_custkey', 7)} < CASE o_orderstatus WHEN 'F' THEN {threshold(0.5)} WHEN 'O' THEN {threshold(0.25)} ELSE -1 END""")
def m4n(spark, sf_dir):
    out = sampling.stratified_sample(_nulled(spark, sf_dir), "o_orderstatus", {"F": 0.5, "O": 0.25}, ["k", "o_custkey"], seed=7)
    return out.select("o_orderkey", "o_orderstatus")


@query("m5_folds_null_keys", f"SELECT o_orderkey, (({hsql('k', 42)}) * 3 // 4294967296)::INTEGER AS fold FROM {_NULLED}")
def m5n(spark, sf_dir):
    return sampling.with_folds(_nulled(spark, sf_dir), "k", 3, seed=42).select("o_orderkey", "fold")


@query("m1_whole_sample", "SELECT o_orderkey FROM orders")
def m1w(spark, sf_dir):
    return sampling.sample(T(spark, sf_dir, "orders").select("o_orderkey"), 1.0, seed=42)


# ================================================================ 2.8 features

_BRAND_RANK = """
brand_rank AS (
  SELECT p_brand, (row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1)::DOUBLE AS idx
  FROM part GROUP BY p_brand)"""


@query("f1_string_index", f"""
WITH {_BRAND_RANK.strip()}
SELECT p.p_partkey, p.p_brand, b.idx AS idx_p_brand FROM part p JOIN brand_rank b USING (p_brand)""")
def f1(spark, sf_dir):
    df = T(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return features.string_index("p_brand").fit(df).transform(df)


@query("f2_string_index_many", """
WITH rb AS (SELECT p_brand, (row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1)::DOUBLE AS i FROM part GROUP BY 1),
     rt AS (SELECT p_type, (row_number() OVER (ORDER BY count(*) DESC, p_type) - 1)::DOUBLE AS i FROM part GROUP BY 1),
     rs AS (SELECT CAST(p_size AS VARCHAR) AS s, (row_number() OVER (ORDER BY count(*) DESC, CAST(p_size AS VARCHAR)) - 1)::DOUBLE AS i
            FROM part GROUP BY 1)
SELECT p.p_partkey, rb.i AS idx_p_brand, rt.i AS idx_p_type, rs.i AS idx_p_size
FROM part p JOIN rb USING (p_brand) JOIN rt USING (p_type) JOIN rs ON rs.s = CAST(p.p_size AS VARCHAR)""")
def f2(spark, sf_dir):
    df = T(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    out = features.string_index(["p_brand", "p_type", "p_size"]).fit(df).transform(df)
    return out.select("p_partkey", "idx_p_brand", "idx_p_type", "idx_p_size")


@query("f2_dictionary", """
WITH k AS (SELECT l_orderkey || '-' || l_linenumber AS key, CAST(l_partkey AS VARCHAR) AS part, l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM lineitem),
rk AS (SELECT key, (row_number() OVER (ORDER BY count(*) DESC, key) - 1)::DOUBLE AS i FROM k GROUP BY 1),
rp AS (SELECT part, (row_number() OVER (ORDER BY count(*) DESC, part) - 1)::DOUBLE AS i FROM k GROUP BY 1)
SELECT l_orderkey, l_linenumber, rk.i AS idx_key, rp.i AS idx_part FROM k JOIN rk USING (key) JOIN rp USING (part)""")
def f2d(spark, sf_dir):
    # a column with as many values as rows: no label reaches the driver
    li = T(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), F.col("l_partkey").cast("string").alias("part"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"))
    return features.encode(li, ["key", "part"]).select("l_orderkey", "l_linenumber", "idx_key", "idx_part")


@query("f2_dictionary_unseen", """
WITH d AS (SELECT o_clerk_code AS value, (row_number() OVER (ORDER BY count(*) DESC, o_clerk_code) - 1)::DOUBLE AS i
           FROM (SELECT CAST(o_custkey % 977 AS VARCHAR) AS o_clerk_code FROM orders WHERE o_orderkey % 2 = 0) GROUP BY 1)
SELECT o_orderkey, coalesce(d.i, (SELECT count(*) FROM d)::DOUBLE) AS idx_code
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey % 1009 AS VARCHAR) END AS code FROM orders) o LEFT JOIN d ON d.value = o.code""")
def f2u(spark, sf_dir):
    # a dictionary of other rows: unseen codes and NULL get the code after the last
    o = T(spark, sf_dir, "orders")
    known = features.dictionary(o.filter("o_orderkey % 2 = 0").select((F.col("o_custkey") % 977).cast("string").alias("code")), "code")
    rows = o.select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, (F.col("o_custkey") % 1009).cast("string")).alias("code"))
    return features.encode(rows, "code", {"code": known}).select("o_orderkey", "idx_code")


_FLAG_RANK = """
flag_rank AS (
  SELECT l_returnflag, (row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1) AS idx,
         count(*) OVER () AS k
  FROM lineitem GROUP BY l_returnflag)"""


def _flag_vectors(spark, sf_dir):
    from pyspark.ml import Pipeline
    li = T(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
        "l_returnflag", "l_quantity", "l_tax")
    pipe = Pipeline(stages=[
        # default (strict) handling: k categories give k - 1 slots, the last dropped
        features.string_index("l_returnflag", invalid="error"),
        features.one_hot("idx_l_returnflag", ["flag_vec"], invalid="error"),
        features.assemble(["l_quantity", "flag_vec", "l_tax"], "features"),
    ])
    return pipe.fit(li).transform(li)


@query("f3_one_hot_drop_last", f"""
WITH {_FLAG_RANK.strip()}
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
       CASE WHEN idx < k - 1 THEN idx::INTEGER END AS hot_slot, (k - 1)::INTEGER AS vec_size
FROM lineitem JOIN flag_rank USING (l_returnflag)""")
def f3(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    df = _flag_vectors(spark, sf_dir)
    arr = vector_to_array("flag_vec")
    pos = F.array_position(arr, 1.0).cast("int")
    return df.select("l_orderkey", "l_linenumber",
                     F.when(pos > 0, pos - 1).alias("hot_slot"), F.size(arr).alias("vec_size"))


@query("f4_assemble", f"""
WITH {_FLAG_RANK.strip()}
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity AS f0,
       CASE WHEN idx = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS f1,
       CASE WHEN idx = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS f2, l_tax AS f3
FROM lineitem JOIN flag_rank USING (l_returnflag)""")
def f4(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    df = _flag_vectors(spark, sf_dir)
    a = vector_to_array("features")
    return df.select("l_orderkey", "l_linenumber", *[a[i].alias(f"f{i}") for i in range(4)])


@query("f5_standard_scale", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
       round(l_quantity / stddev_samp(l_quantity) OVER (), 6) AS s0,
       round(l_extendedprice / stddev_samp(l_extendedprice) OVER (), 6) AS s1
FROM lineitem""")
def f5(spark, sf_dir):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    li = T(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
        "l_quantity", "l_extendedprice")
    pipe = Pipeline(stages=[features.assemble(["l_quantity", "l_extendedprice"], "features_assembler"),
                            features.scale("features_assembler", "features")])
    out = pipe.fit(li).transform(li)
    a = vector_to_array("features")
    return out.select("l_orderkey", "l_linenumber", r(a[0]).alias("s0"), r(a[1]).alias("s1"))


_F6 = ["l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax"]


@query("f6_feature_columns", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, "
       + ", ".join(f"{c}::DOUBLE AS f{i}" for i, c in enumerate(_F6)) + " FROM lineitem")
def f6(spark, sf_dir):
    # the feature list of the roles, assembled over the rows
    from pyspark.ml.functions import vector_to_array
    df = T(spark, sf_dir, "lineitem")
    roles = columns.infer_roles(df, label="l_extendedprice", ids=["l_orderkey", "l_linenumber"], max_distinct=100)
    names = features.feature_columns(roles, "none")
    a = vector_to_array("features")
    return features.assemble(names, "features").transform(df).select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), *[a[i].alias(f"f{i}") for i in range(len(names))])


# ================================================================ 2.11 evaluation

@query("e1_regression_metrics", f"""
WITH {PRED_CTE.strip()}
SELECT count(*)::BIGINT AS rows, round(sqrt(avg((y - yhat) * (y - yhat))), 4) AS rmse,
       round(avg((y - yhat) * (y - yhat)), 2) AS mse, round(avg(abs(y - yhat)), 4) AS mae,
       round(1 - sum((y - yhat) * (y - yhat)) / (var_samp(y) * (count(*) - 1)), 6) AS r2
FROM pred""")
def e1(spark, sf_dir):
    m = evaluate.regression_metrics(pred_frame(spark, sf_dir), "y", "yhat")
    return m.select("rows", r("rmse", 4).alias("rmse"), r("mse", 2).alias("mse"),
                    r("mae", 4).alias("mae"), r("r2").alias("r2"))


_CELLS = """
cells AS (SELECT sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END)::DOUBLE AS tp,
                 sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END)::DOUBLE AS fp,
                 sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END)::DOUBLE AS tn,
                 sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END)::DOUBLE AS fn FROM pred)"""


@query("e2_auc_hard_prediction", f"""
WITH {PRED_CTE.strip()}, {_CELLS.strip()}
SELECT round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS auc_hard FROM cells""")
def e2(spark, sf_dir):
    return evaluate.auc_hard(pred_frame(spark, sf_dir)).select(r("auc_hard").alias("auc_hard"))


@query("e3_auc_swapped_pair", f"""
WITH {PRED_CTE.strip()}, {_CELLS.strip()}
SELECT round((tp / (tp + fp) + tn / (tn + fn)) / 2, 6) AS auc_swapped FROM cells""")
def e3(spark, sf_dir):
    return evaluate.auc_swapped(pred_frame(spark, sf_dir)).select(r("auc_swapped").alias("auc_swapped"))


@query("e4_auc_exact_score", f"""
WITH {PRED_CTE.strip()},
g AS (SELECT score AS s, sum(label) AS pos, sum(1 - label) AS neg FROM pred GROUP BY score),
c AS (SELECT s, pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM g)
SELECT round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc FROM c""")
def e4(spark, sf_dir):
    return evaluate.exact_auc(pred_frame(spark, sf_dir), "label", "score").select(r("auc").alias("auc"))


@query("e4_auc_pr", f"""
WITH {PRED_CTE.strip()},
g AS (SELECT score AS s, sum(label) AS pos, sum(1 - label) AS neg FROM pred GROUP BY score),
c AS (SELECT pos, neg,
             coalesce(sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS tp0,
             coalesce(sum(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fp0,
             sum(pos) OVER () AS p_all
      FROM g),
pts AS (SELECT pos / p_all AS dx, (tp0 + pos) / (tp0 + pos + fp0 + neg) AS prec,
               CASE WHEN tp0 + fp0 > 0 THEN tp0 / (tp0 + fp0)
                    ELSE (tp0 + pos) / (tp0 + pos + fp0 + neg) END AS prec0
        FROM c)
SELECT round(sum(dx * (prec + prec0) / 2), 6) AS auc_pr FROM pts""")
def e4pr(spark, sf_dir):
    out = evaluate.auc(pred_frame(spark, sf_dir), "label", "score", metric="areaUnderPR")
    return out.select(r("auc_pr").alias("auc_pr"))


@query("e5_confusion", f"""
WITH {PRED_CTE.strip()}
SELECT count(*)::BIGINT AS total,
       sum(CASE WHEN label = prediction THEN 1 ELSE 0 END)::BIGINT AS correct,
       sum(CASE WHEN label <> prediction THEN 1 ELSE 0 END)::BIGINT AS wrong,
       round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS ratio_correct,
       round(avg(CASE WHEN label <> prediction THEN 1.0 ELSE 0.0 END), 6) AS ratio_wrong,
       sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END)::BIGINT AS tp,
       sum(CASE WHEN label <> 1 AND prediction = 1 THEN 1 ELSE 0 END)::BIGINT AS fp,
       sum(CASE WHEN label <> 1 AND prediction <> 1 THEN 1 ELSE 0 END)::BIGINT AS tn,
       sum(CASE WHEN label = 1 AND prediction <> 1 THEN 1 ELSE 0 END)::BIGINT AS fn,
       round(avg(CASE WHEN prediction = 0 AND label = prediction THEN 1.0 ELSE 0.0 END), 6) AS pred0_correct,
       round(avg(CASE WHEN prediction = 1 AND label = prediction THEN 1.0 ELSE 0.0 END), 6) AS pred1_correct,
       round(avg(CASE WHEN prediction = 1 AND label <> prediction THEN 1.0 ELSE 0.0 END), 6) AS pred1_wrong,
       round(avg(CASE WHEN prediction = 0 AND label <> prediction THEN 1.0 ELSE 0.0 END), 6) AS pred0_wrong
FROM pred""")
def e5(spark, sf_dir):
    c = evaluate.confusion(pred_frame(spark, sf_dir))
    ratios = ["ratio_correct", "ratio_wrong", "pred0_correct", "pred1_correct", "pred1_wrong", "pred0_wrong"]
    return c.select(*[r(x).alias(x) if x in ratios else F.col(x) for x in c.columns])


@query("e6_accuracy", f"""
WITH {PRED_CTE.strip()}
SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(1 - avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS error_rate FROM pred""")
def e6(spark, sf_dir):
    a = evaluate.accuracy(pred_frame(spark, sf_dir))
    return a.select(r("accuracy").alias("accuracy"), r("error_rate").alias("error_rate"))


_MC_CTE = """
mc AS (SELECT CASE l_returnflag WHEN 'A' THEN 0.0 WHEN 'N' THEN 1.0 ELSE 2.0 END AS y,
              CASE WHEN l_quantity < 17 THEN 0.0 WHEN l_quantity < 34 THEN 1.0 ELSE 2.0 END AS p FROM lineitem),
cells AS (SELECT y, p, count(*) AS n FROM mc GROUP BY y, p),
bl AS (SELECT y AS k, sum(n) AS n_true, coalesce(sum(CASE WHEN y = p THEN n END), 0) AS tp FROM cells GROUP BY y),
bp AS (SELECT p AS k, sum(n) AS n_pred FROM cells GROUP BY p),
per AS (SELECT bl.n_true, bl.tp,
               CASE WHEN bp.n_pred > 0 THEN bl.tp::DOUBLE / bp.n_pred ELSE 0 END AS prec,
               bl.tp::DOUBLE / bl.n_true AS rec FROM bl LEFT JOIN bp USING (k))"""


def _mc_frame(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem")
    return li.select(
        F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0)
        .otherwise(2.0).alias("label"),
        F.when(F.col("l_quantity") < 17, 0.0).when(F.col("l_quantity") < 34, 1.0)
        .otherwise(2.0).alias("prediction"))


@query("e7_multiclass_metrics", f"""
WITH {_MC_CTE.strip()}
SELECT round(sum(tp)::DOUBLE / sum(n_true), 6) AS accuracy,
       round(sum(prec * n_true) / sum(n_true), 6) AS weighted_precision,
       round(sum(rec * n_true) / sum(n_true), 6) AS weighted_recall,
       round(sum(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END * n_true) / sum(n_true), 6)
         AS weighted_f1
FROM per""")
def e7(spark, sf_dir):
    m = evaluate.multiclass_metrics(_mc_frame(spark, sf_dir))
    return m.select(*[r(c).alias(c) for c in m.columns])


# ================================================================ 2.9 models

@query("l1_linear_one_feature", """
SELECT round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept,
       round(regr_slope(l_extendedprice, l_quantity), 6) AS slope FROM lineitem""")
def l1(spark, sf_dir):
    from pyspark.ml.regression import LinearRegression
    li = T(spark, sf_dir, "lineitem").select("l_quantity", F.col("l_extendedprice").alias("label"))
    va = features.assemble(["l_quantity"], "features")
    m = LinearRegression(solver="normal", regParam=0.0, standardization=False).fit(va.transform(li))
    return spark.createDataFrame([(float(m.intercept), float(m.coefficients[0]))],
                                 "intercept double, slope double").select(
        r("intercept", 3).alias("intercept"), r("slope").alias("slope"))


@query("l1_l11_claims_linear_cv")
def l1cv(spark, sf_dir):
    return jobs.claims_regression(spark, sf_dir)


@query("l2_l11_claims_rf_cv")
def l2cv(spark, sf_dir):
    return jobs.claims_regression(spark, sf_dir, kind="rf_reg")


@query("l2_rf_regressor_demand")
def l2(spark, sf_dir):
    return jobs.demand_regression(spark, sf_dir)


# Closed forms of the estimators: settings under which SQL gives the same model.

def _split_frame(spark, sf_dir):
    """Line items with one binary feature: is the price above 40 000?"""
    li = T(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_extendedprice",
        (F.col("l_extendedprice") > 40000).cast("double").alias("x"),
        F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0).alias("y"))
    return features.assemble(["x"], "features").transform(li)


_SPLIT_CTE = """
t AS (SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_extendedprice,
             CASE WHEN l_extendedprice > 40000 THEN 1.0 ELSE 0.0 END::DOUBLE AS x,
             CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END::DOUBLE AS y FROM lineitem)"""
_ONE_TREE = {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all", "maxDepth": 1}
_MAJORITY_SQL = f"""
WITH {_SPLIT_CTE.strip()}, g AS (SELECT x, CASE WHEN avg(y) > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction FROM t GROUP BY x)
SELECT l_orderkey, l_linenumber, prediction FROM t JOIN g USING (x)"""


@query("l2_one_split_means", f"""
WITH {_SPLIT_CTE.strip()}, g AS (SELECT x, avg(l_extendedprice) AS m FROM t GROUP BY x)
SELECT l_orderkey, l_linenumber, round(m, 4) AS prediction FROM t JOIN g USING (x)""")
def l2s(spark, sf_dir):
    df = _split_frame(spark, sf_dir)
    model = models.estimator("rf_reg", label="l_extendedprice", **_ONE_TREE).fit(df)
    return models.score(model, df).select("l_orderkey", "l_linenumber", r("prediction", 4).alias("prediction"))


@query("l3_class_rates", f"""
WITH {_SPLIT_CTE.strip()}, g AS (SELECT x, avg(y) AS m FROM t GROUP BY x)
SELECT l_orderkey, l_linenumber, round(m, 3) AS chance FROM t JOIN g USING (x)""")
def l3r(spark, sf_dir):
    df = _split_frame(spark, sf_dir)
    model = models.estimator("logistic", label="y", regParam=0.0, maxIter=200, tol=1e-12).fit(df)
    return models.score(model, df).select("l_orderkey", "l_linenumber", r(evaluate.score_of("probability"), 3).alias("chance"))


@query("l4_separable_classes", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
FROM lineitem""")
def l4s(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
                                             (F.col("l_returnflag") == "R").cast("double").alias("x"))
    df = features.assemble(["x"], "features").transform(li)
    # every step of the solver reads its rows; the rows of a class are all equal, so each counts for them
    classes = features.assemble(["x"], "features").transform(li.groupBy("x").agg(F.count(F.lit(1)).cast("double").alias("n")))
    model = models.estimator("svc", label="x", maxIter=100, regParam=0.0001, weightCol="n").fit(classes)
    return models.score(model, df).select("l_orderkey", "l_linenumber", "prediction")


@query("l5_one_split_majority", _MAJORITY_SQL)
def l5s(spark, sf_dir):
    df = _split_frame(spark, sf_dir)
    model = models.estimator("tree", label="y", maxDepth=1).fit(df)
    return models.score(model, df).select("l_orderkey", "l_linenumber", "prediction")


@query("l6_one_split_majority", _MAJORITY_SQL)
def l6s(spark, sf_dir):
    df = _split_frame(spark, sf_dir)
    model = models.estimator("rf_cls", label="y", **_ONE_TREE).fit(df)
    return models.score(model, df).select("l_orderkey", "l_linenumber", "prediction")


@query("l3_logistic_churn")
def l3(spark, sf_dir):
    return jobs.churn_classification(spark, sf_dir, "logistic")


@query("l4_linear_svc_churn")
def l4(spark, sf_dir):
    return jobs.churn_classification(spark, sf_dir, "svc")


@query("l5_decision_tree_churn")
def l5(spark, sf_dir):
    return jobs.churn_classification(spark, sf_dir, "tree", frame="orders")


@query("l5_tree_churn_by_hard_decision")
def l5h(spark, sf_dir):
    # the search selects by the area of the hard decision
    return jobs.churn_classification(spark, sf_dir, "tree", frame="orders", select_by="prediction")


@query("l6_rf_classifier_churn")
def l6(spark, sf_dir):
    return jobs.churn_classification(spark, sf_dir, "rf_cls", frame="orders")


@query("l7_l9_pipeline_fit_score", f"""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END::DOUBLE AS label, true AS scored
FROM orders WHERE {hsql('o_orderkey', 42)} >= {threshold(0.8)}""")
def l9(spark, sf_dir):
    df = standins.churn_orders_frame(spark, sf_dir)
    train, test = sampling.hash_split(df, "o_orderkey", [0.8, 0.2], seed=42)
    est = models.estimator("logistic")
    model = models.fit(models.build_pipeline(standins.CHURN_ORDERS_ROLES, est, label_source="churn"), train)
    return models.score(model, test).select("o_orderkey", "label", F.col("prediction").isin(0.0, 1.0).alias("scored"))


def _unlabelled(spark, sf_dir):
    """A model of the even orders, and the odd ones as a file to score: no label, other priorities, missing numbers."""
    df = standins.churn_orders_frame(spark, sf_dir)
    old = df.filter("o_orderkey % 2 = 0").withColumn("late", (F.col("totalprice") > 100000).cast("double"))
    est = models.estimator("tree", maxDepth=1, impurity="gini")
    roles = columns.Roles(categorical=("o_orderpriority",), numeric=("late",), label="churn")
    model = models.fit(models.build_pipeline(roles, est, encode="index", label_source="churn"), old)
    late = F.when(F.col("o_orderkey") % 11 != 0, (F.col("totalprice") > 100000).cast("double")).alias("late")
    new = df.filter("o_orderkey % 2 = 1").select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "9-NEW").when(F.col("o_orderkey") % 13 != 0, F.col("o_orderpriority")).alias("o_orderpriority"), late)
    return model, new


@query("l9_drift_report", """
WITH n AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 2 = 1)
SELECT 'o_orderpriority' AS column_name, 'category' AS kind, count(*)::BIGINT AS n_rows,
       count(*) FILTER (k % 7 <> 0 AND k % 13 = 0)::BIGINT AS n_null, count(*) FILTER (k % 7 = 0)::BIGINT AS n_unseen FROM n
UNION ALL SELECT 'late', 'number', count(*)::BIGINT, count(*) FILTER (k % 11 = 0)::BIGINT, 0::BIGINT FROM n""")
def l9d(spark, sf_dir):
    return models.drift_report(*_unlabelled(spark, sf_dir))


@query("l9_score_unlabelled", f"""
WITH {_SPLIT_CTE.strip()}, g AS (SELECT x, CASE WHEN avg(y) > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction FROM t WHERE l_linenumber <= 3 GROUP BY x)
SELECT l_orderkey, l_linenumber, prediction FROM t JOIN g USING (x) WHERE l_linenumber > 3""")
def l9u(spark, sf_dir):
    # the label is text that the pipeline indexes; the rows to score have none
    df = _split_frame(spark, sf_dir).withColumn("label_text", F.when(F.col("y") == 1.0, "yes").otherwise("no")).drop("features", "y")
    roles = columns.Roles(numeric=("x",), label="label_text")
    model = models.fit(models.build_pipeline(roles, models.estimator("tree", maxDepth=1), encode="none", label_source="label_text"), df.filter("l_linenumber <= 3"))
    rows = df.filter("l_linenumber > 3").drop("label_text")
    return models.score(models.label_free(model), rows).select("l_orderkey", "l_linenumber", "prediction")


def _fold_rmse(fold: int, where: str, slope: str, intercept: str) -> str:
    return (f"SELECT sqrt(avg(power(v.y - (m.a + m.b * v.x), 2))) AS rmse FROM f v, "
            f"(SELECT {slope} AS b, {intercept} AS a FROM f WHERE fold <> {fold}) m WHERE v.fold = {fold}{where}")


_CV_SQL = f"""
WITH f AS (SELECT l_quantity AS x, l_extendedprice AS y,
                  (({hsql2('l_orderkey', 'l_linenumber', 7)}) * 3 // 4294967296)::INTEGER AS fold FROM lineitem),
w AS ({' UNION ALL '.join(_fold_rmse(k, '', 'regr_slope(y, x)', 'regr_intercept(y, x)') for k in range(3))}),
z AS ({' UNION ALL '.join(_fold_rmse(k, '', 'sum(x * y) / sum(x * x)', '0') for k in range(3))}),
b AS (SELECT 0::BIGINT AS combo, avg(rmse) AS m FROM z UNION ALL SELECT 1, avg(rmse) FROM w)
SELECT combo, round(m, 3) AS avg_metric, m = (SELECT min(m) FROM b) AS is_best FROM b"""


@query("l10_l12_cv_closed_form", _CV_SQL)
def l11c(spark, sf_dir):
    # one feature, no penalty: every fold's fit and error have closed forms
    li = T(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_extendedprice").alias("label"))
    df = sampling.with_folds(li, ["l_orderkey", "l_linenumber"], 3, seed=7)
    est = models.estimator("linear", solver="normal", regParam=0.0, standardization=False)
    pipe = models.build_pipeline(columns.Roles(numeric=("l_quantity",)), est, encode="none")
    cv = models.tune(pipe, models.grid(est, {"fitIntercept": [False, True]}), models.evaluator("linear"), df, folds=3,
                     parallelism=2, fold_col="fold", columns=["l_quantity", "label"])
    return models.cv_table(cv).select("combo", r("avg_metric", 3).alias("avg_metric"), "is_best")


def _folded_split(spark, sf_dir):
    """The split frame with folds and a label that the split tells something about (else Spark merges its equal sides)."""
    li = T(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", (F.col("l_extendedprice") > 40000).cast("double").alias("x"),
        F.when(F.col("l_extendedprice") + 1000 * F.col("l_quantity") > 60000, 1.0).otherwise(0.0).alias("y"))
    return sampling.with_folds(li, ["l_orderkey", "l_linenumber"], 3, seed=7)


_SPLIT_FOLDS = f"""
f AS (SELECT CASE WHEN l_extendedprice > 40000 THEN 1.0 ELSE 0.0 END::DOUBLE AS x, l_extendedprice AS v,
             CASE WHEN l_extendedprice + 1000 * l_quantity > 60000 THEN 1.0 ELSE 0.0 END::DOUBLE AS y,
             (({hsql2('l_orderkey', 'l_linenumber', 7)}) * 3 // 4294967296)::INTEGER AS fold FROM lineitem),
k AS (SELECT unnest([0, 1, 2]) AS k)"""


@query("l2_l11_forest_cv_closed_form", f"""
WITH {_SPLIT_FOLDS.strip()},
m0 AS (SELECT k, avg(v) AS m FROM k JOIN f ON f.fold <> k GROUP BY k),
m1 AS (SELECT k, x, avg(v) AS m FROM k JOIN f ON f.fold <> k GROUP BY k, x),
e AS (SELECT 0::BIGINT AS combo, fold, sqrt(avg(power(v - m, 2))) AS rmse FROM f JOIN m0 ON k = fold GROUP BY fold
      UNION ALL SELECT 1, fold, sqrt(avg(power(v - m, 2))) FROM f JOIN m1 ON k = fold AND m1.x = f.x GROUP BY fold),
b AS (SELECT combo, avg(rmse) AS m FROM e GROUP BY combo)
SELECT combo, round(m, 3) AS avg_metric, m = (SELECT min(m) FROM b) AS is_best FROM b""")
def l2cf(spark, sf_dir):
    # one binary feature: no split predicts the mean, one split the means of both groups; one fit a fold gives both
    est = models.estimator("rf_reg", label="l_extendedprice", numTrees=1, bootstrap=False, featureSubsetStrategy="all")
    pipe = models.build_pipeline(columns.Roles(numeric=("x",)), est, encode="none")
    cv = models.tune(pipe, models.grid(est, {"maxDepth": [0, 1]}), models.evaluator("rf_reg", label="l_extendedprice"), _folded_split(spark, sf_dir),
                     folds=3, parallelism=3, fold_col="fold", columns=["x", "l_extendedprice"])
    return models.cv_table(cv).select("combo", r("avg_metric", 3).alias("avg_metric"), "is_best")


@query("l6_l11_forest_cv_closed_form", f"""
WITH {_SPLIT_FOLDS.strip()},
m AS (SELECT k, x, avg(y) AS s FROM k JOIN f ON f.fold <> k GROUP BY k, x),
g AS (SELECT k, f.x, s, sum(y) AS pos, sum(1 - y) AS neg FROM f JOIN m ON k = fold AND m.x = f.x GROUP BY k, f.x, s),
a AS (SELECT a.k, sum(a.pos * CASE WHEN b.s < a.s THEN b.neg WHEN b.s = a.s THEN b.neg / 2 ELSE 0 END) / (sum(a.pos * b.neg)) AS auc
      FROM g a JOIN g b ON a.k = b.k GROUP BY a.k),
b AS (SELECT 0::BIGINT AS combo, 0.5::DOUBLE AS m UNION ALL SELECT 1, avg(auc) FROM a)
SELECT combo, round(m, 6) AS avg_metric, m = (SELECT max(m) FROM b) AS is_best FROM b""")
def l6cf(spark, sf_dir):
    # the area under the curve of no split is a half, that of one split follows from the two groups
    est = models.estimator("rf_cls", label="y", numTrees=1, bootstrap=False, featureSubsetStrategy="all")
    pipe = models.build_pipeline(columns.Roles(numeric=("x",)), est, encode="none")
    cv = models.tune(pipe, models.grid(est, {"maxDepth": [0, 1]}), models.evaluator("rf_cls", label="y"), _folded_split(spark, sf_dir),
                     folds=3, parallelism=3, fold_col="fold", columns=["x", "y"])
    return models.cv_table(cv).select("combo", r("avg_metric", 6).alias("avg_metric"), "is_best")


@query("l10_l12_grid_search_table")
def l11(spark, sf_dir):
    df = sampling.with_folds(standins.churn_orders_frame(spark, sf_dir), "o_orderkey", 3, seed=7)
    est = models.estimator("tree")
    pipe = models.build_pipeline(standins.CHURN_ORDERS_ROLES, est, encode="index", label_source="churn")
    space = models.at_least_bins(models.WORKLOAD_GRIDS["tree"], models.nominal_bins(df, standins.CHURN_ORDERS_ROLES))
    cv = models.tune(pipe, models.grid(est, space),
                     models.evaluator("tree"), df, folds=3, parallelism=2, fold_col="fold")
    return models.cv_table(cv)


@query("l12_best_params")
def l12(spark, sf_dir):
    df = sampling.with_folds(standins.churn_frame(spark, sf_dir), "doc_id", 3, seed=7)
    est = models.estimator("logistic")
    pipe = models.build_pipeline(standins.CHURN_ROLES, est, label_source="churn")
    cv = models.tune(pipe, models.grid(est, {"regParam": [0.1, 0.01], "fitIntercept": [False, True],
                                             "elasticNetParam": [0.0, 0.5, 1.0]}),
                     models.evaluator("logistic"), df, folds=3, parallelism=4, fold_col="fold")
    return models.best_params(cv, ["regParam", "fitIntercept", "elasticNetParam", "maxIter", "tol"])


def _importances(spark, sf_dir):
    df = cleaning.drop_nulls(standins.bike_frame(spark, sf_dir), [*standins.BIKE_ROLES.numeric, "cnt"])
    train, test = sampling.hash_split(df, "instant", [0.7, 0.3], seed=42)
    est = models.estimator("rf_reg", label="cnt", numTrees=100, maxDepth=20)
    model = models.fit(models.build_pipeline(standins.BIKE_ROLES, est, scale_features=True), train, "instant")
    return models.feature_importances(model, model.transform(test))


@query("l13_feature_importances")
def l13(spark, sf_dir):
    return _importances(spark, sf_dir)


@query("l13_importance_slots", f"""
WITH {BIKE_CTE.strip()},
tr AS (SELECT * FROM bike WHERE hum IS NOT NULL AND cnt IS NOT NULL AND {hsql('instant', 42)} < {threshold(0.7)})
SELECT (count(DISTINCT season) + count(DISTINCT yr) + count(DISTINCT workingday) + count(DISTINCT weathersit) + 4 + 5)::BIGINT AS slots,
       1.0::DOUBLE AS total FROM tr""")
def l13s(spark, sf_dir):
    # a slot for every category of the training part, one a column for unseen ones, and every number
    return _importances(spark, sf_dir).agg(F.count(F.lit(1)).alias("slots"), r(F.sum("importance")).alias("total"))


@query("l14_leaderboard")
def l14(spark, sf_dir):
    df = standins.churn_orders_frame(spark, sf_dir)
    train, test = sampling.hash_split(df, "o_orderkey", [0.8, 0.2], seed=42)
    fitted = {}
    with models.reused(train, "o_orderkey") as held:  # one held training split for all fits
        for kind in ("logistic", "svc", "tree"):
            encode = "index" if kind in models.TREE_KINDS else "onehot"
            fitted[kind] = models.fit(models.build_pipeline(standins.CHURN_ORDERS_ROLES, models.estimator(kind), encode=encode, label_source="churn"), held)
        est = models.estimator("rf_cls")
        fitted["rf_cls"] = models.fit(models.build_pipeline(standins.CHURN_ORDERS_ROLES, est, encode="index", label_source="churn"), held)
    return jobs.leaderboard(fitted, test)


# Fixed rules in place of fitted models: SQL gives their scores.
_RULES = {"dear": ("o_totalprice", "o_totalprice > 150000"), "old": ("-year(o_orderdate)", "year(o_orderdate) < 1995"),
          "urgent": ("CASE WHEN o_orderpriority LIKE '1%' THEN 1 ELSE 0 END", "o_orderpriority LIKE '1%'")}
_RULE_ROWS = " UNION ALL ".join(
    f"SELECT '{n}' AS model, CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END::DOUBLE AS y, CASE WHEN {p} THEN 1.0 ELSE 0.0 END::DOUBLE AS p, ({s})::DOUBLE AS s FROM orders" for n, (s, p) in _RULES.items())
_BOARD_METRICS = ("accuracy", "error_rate", "auc_hard", "auc_swapped", "auc_score", "auc_pr")


@query("l14_fixed_rules", f"""
WITH t AS ({_RULE_ROWS}),
cells AS (SELECT model, sum(y * p) AS tp, sum((1 - y) * p) AS fp, sum((1 - y) * (1 - p)) AS tn, sum(y * (1 - p)) AS fn FROM t GROUP BY model),
g AS (SELECT model, s, sum(y) AS pos, sum(1 - y) AS neg FROM t GROUP BY model, s),
c AS (SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY s DESC) AS tp, sum(neg) OVER (PARTITION BY model ORDER BY s DESC) AS fp,
             sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n FROM g),
areas AS (SELECT model, sum(pos * (n - fp + neg / 2)) / (max(p) * max(n)) AS auc_score,
                 sum(pos / p * (tp / (tp + fp) + CASE WHEN tp - pos + fp - neg > 0 THEN (tp - pos) / (tp - pos + fp - neg) ELSE tp / (tp + fp) END) / 2) AS auc_pr
          FROM c GROUP BY model),
wide AS (SELECT model, (tp + tn) / (tp + fp + tn + fn) AS accuracy, 1 - (tp + tn) / (tp + fp + tn + fn) AS error_rate,
                (tp / (tp + fn) + tn / (tn + fp)) / 2 AS auc_hard, (tp / (tp + fp) + tn / (tn + fn)) / 2 AS auc_swapped, auc_score, auc_pr
         FROM cells JOIN areas USING (model)),
l AS ({" UNION ALL ".join(f"SELECT model, '{m}' AS metric, {m} AS value FROM wide" for m in _BOARD_METRICS)})
SELECT 'rules' AS run, model, metric, round(value, 6) AS value,
       row_number() OVER (PARTITION BY metric ORDER BY CASE WHEN metric = 'error_rate' THEN value ELSE -value END NULLS LAST, model)::INTEGER AS rank FROM l""")
def l14r(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    each = F.array(*[F.struct(F.lit(n).alias("model"), F.expr(f"CASE WHEN {p} THEN 1.0D ELSE 0.0D END").alias("prediction"), F.expr(f"CAST({s} AS DOUBLE)").alias("score"))
                     for n, (s, p) in _RULES.items()])
    rows = o.select((F.col("o_orderstatus") == "F").cast("double").alias("label"), F.explode(each).alias("m")).select("label", "m.*")
    return jobs.ranked_metrics(rows, run="rules").withColumn("value", r("value"))

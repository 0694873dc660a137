import math

from pyspark.sql import functions as F

from conftest import SF_MID
from tabula.operators import charts, profile


def li(spark):
    return spark.read.parquet(f"{SF_MID}/lineitem.parquet")


def test_skewness_is_population(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,)], "x double")
    s = profile.skewness(df, ["x"]).first().skewness
    xs = [1.0, 2.0, 10.0]
    m = sum(xs) / 3
    m2 = sum((x - m) ** 2 for x in xs) / 3
    m3 = sum((x - m) ** 3 for x in xs) / 3
    assert math.isclose(s, m3 / m2 ** 1.5, rel_tol=1e-9)


def test_describe_sample_stddev(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    d = {r.summary: r.x for r in profile.describe(df).collect()}
    assert math.isclose(float(d["stddev"]), 1.2909944487358056, rel_tol=1e-9)


def test_corr_matrix_single_scan(spark):
    df = li(spark)
    cm = profile.corr_matrix(df, ["l_quantity", "l_tax", "l_discount"])
    assert cm.count() == 3
    plan = cm._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_drop_correlated(spark):
    df = li(spark).select("l_quantity", "l_extendedprice",
                          (F.col("l_extendedprice") * 1.01).alias("dup"))
    pruned, dropped = profile.drop_correlated(df, None, 0.95)
    assert dropped == ["dup"] and pruned.columns == ["l_quantity", "l_extendedprice"]


def test_class_balance(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2, "c string")
    got = {r["class"]: (r.n, r.share, r.fraction) for r in profile.class_balance(df, "c").collect()}
    assert got == {"a": (6, 0.75, 2 / 6), "b": (2, 0.25, 1.0)}


def test_cardinality_exact_and_approx(spark):
    part = spark.read.parquet(f"{SF_MID}/part.parquet")
    ex = {r.column_name: r.distinct_count for r in profile.cardinality(part, ["p_brand", "p_type"]).collect()}
    ap = {r.column_name: r.distinct_count for r in profile.cardinality(part, ["p_brand", "p_type"], exact=False).collect()}
    assert ex == {"p_brand": 25, "p_type": 6} and ap == ex


def test_scatter_is_bounded_top_n(spark):
    df = spark.read.parquet(f"{SF_MID}/orders.parquet")
    out = charts.scatter_data(df, ["o_totalprice"], 50, "o_orderkey", 1)
    assert out.count() == 50
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_peak_keys_order(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 7.0), (4, 1.0)], "k int, v double")
    assert [r.k for r in charts.peak_keys(df, "k", "v", 2).collect()] == [2, 3]
    assert [r.k for r in charts.peak_keys(df, "k", "v", 1, desc=False).collect()] == [4]


def test_constant_columns_have_no_correlation(spark):
    from pyspark.sql import functions as F
    df = spark.range(20).select(F.col("id").cast("double").alias("a"), F.lit(3.0).alias("c"), (F.col("id") * -2.0).alias("b"),
                                F.when(F.col("id") < 10, F.col("id") * 1.0).alias("h"))
    assert profile.corr(df, "a", "c").first()[0] is None
    got = {(r.a, r.b): r.r for r in profile.corr_matrix(df).collect()}
    assert got[("a", "c")] is None and abs(got[("a", "b")] + 1) < 1e-12 and abs(got[("a", "h")] - 1) < 1e-12
    assert profile.drop_correlated(df)[1] == ["b", "h"]


def test_high_cardinality_counts_only_what_the_sketch_leaves(spark):
    from pyspark.sql import functions as F
    df = spark.range(5000).select((F.col("id") % 7).alias("few"), (F.col("id") % 100).alias("edge"), F.col("id").alias("many"), F.lit(None).cast("int").alias("none"))
    got = {r.column_name: r.distinct_count for r in profile.high_cardinality(df, df.columns, 99).collect()}
    assert got == {"edge": 100, "many": 5000}
    assert {r.column_name: r.distinct_count for r in profile.cardinality(df, df.columns).collect()} == {"few": 7, "edge": 100, "many": 5000, "none": 0}

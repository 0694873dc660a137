import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tabula.sources import (CHURN_SCHEMA, cache_view, list_files, load_model, materialize, read_csv,
                            read_table, register, save_model, schema_table, write_metrics)
from tabula.sources.sinks import read_metrics


def _write(path, text):
    path = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_csv_inferred_and_blank_is_null(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.csv")
    _write(p, "n,s\n1,a\n2,\n,\n")
    df = read_csv(spark, p)
    assert dict(df.dtypes) == {"n": "int", "s": "string"}
    rows = sorted(df.collect(), key=lambda r: (r.n is None, r.n))
    assert [tuple(r) for r in rows] == [(1, "a"), (2, None), (None, None)]


def test_declared_schema_binds_by_position_and_na_token(spark, tmp_dir):
    p = os.path.join(tmp_dir, "churn.csv")
    header = ",".join(f"File Col {i}" for i in range(20))
    row1 = ",".join(["KS", "128", "415", "no", "yes"] + ["1.5"] * 14 + ["False"])
    row2 = ",".join(["OH", "NA", "415", "no", "yes"] + ["NA"] * 14 + ["True"])
    _write(p, f"{header}\n{row1}\n{row2}\n")
    df = read_csv(spark, p, schema=CHURN_SCHEMA, null_value="NA")
    assert df.columns == [f.name for f in CHURN_SCHEMA.fields]
    got = {r.state_code: r for r in df.collect()}
    assert got["KS"].account_length == 128 and got["KS"].customer_service_calls == 1.5
    assert got["OH"].account_length is None and got["OH"].total_day_mins is None
    assert got["OH"].churn == "True"


def test_other_formats_roundtrip(spark, tmp_dir):
    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_totalprice")
    for fmt in ("parquet", "orc", "json"):
        path = os.path.join(tmp_dir, fmt)
        src.write.format(fmt).save(path)
        back = read_table(spark, path, fmt, schema="o_orderkey bigint, o_totalprice double")
        assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0


def test_catalog_helpers(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    m = materialize(df)
    assert m.is_cached
    m.unpersist()
    register(df, "My_Orders")
    assert spark.sql("select count(*) c from my_orders").first().c == df.count()
    assert cache_view(spark, "my_orders") is True
    spark.catalog.uncacheTable("my_orders")
    files = list_files(spark, f"{SF_SMALL}/*.parquet")
    assert files.columns == ["path", "length", "modification_time"]
    assert files.count() == 14
    st = schema_table(df)
    assert [r.column_name for r in st.orderBy("position").collect()] == df.columns


def test_metrics_sink_appends(spark, tmp_dir):
    m = spark.createDataFrame([("r1", "m", "rmse", 1.5)], "run string, model string, metric string, value double")
    path = os.path.join(tmp_dir, "metrics")
    write_metrics(m, path)
    write_metrics(m, path)
    assert read_metrics(spark, path).count() == 2


def test_model_save_load_scores_equal(spark, tmp_dir):
    from tabula.plans import models, standins
    df = standins.churn_orders_frame(spark, SF_SMALL)
    est = models.estimator("tree", maxDepth=3)
    model = models.build_pipeline(standins.CHURN_ORDERS_ROLES, est, encode="index",
                                  label_source="churn").fit(df)
    path = os.path.join(tmp_dir, "model")
    save_model(model, path)
    again = load_model(path)
    a = model.transform(df).select("o_orderkey", F.col("prediction").alias("a"))
    b = again.transform(df).select("o_orderkey", F.col("prediction").alias("b"))
    assert a.join(b, "o_orderkey").filter("a <> b").count() == 0

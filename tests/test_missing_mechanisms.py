"""Moment matrix, dictionaries, one-scan cardinality, drift report, bounded scatter: against plain versions and odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tabula.operators import charts, profile
from tabula.plans import features, models, standins


def _plain_corr(a, b):
    both = [(x, y) for x, y in zip(a, b) if x is not None and y is not None]
    if not both:
        return None
    x, y = (np.array(v, float) for v in zip(*both))
    if x.std() == 0 or y.std() == 0:
        return None
    return float(np.corrcoef(x, y)[0, 1])


def test_pairwise_complete_correlations(spark):
    rng = np.random.default_rng(1)
    rows = []
    for k in range(500):
        x = float(rng.normal())
        rows.append((x if k % 3 else None, x + float(rng.normal()) if k % 5 else None, 1e9 + x, 7.5, None, 3.0 if k % 2 else None, k))
    cols = [*"abcdef", "g h"]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double, `g h` int").repartition(5)
    got = {(r.a, r.b): r.r for r in profile.corr_matrix(df, cols).collect()}
    assert len(got) == 21
    for i, a in enumerate(cols):
        for j in range(i + 1, len(cols)):
            want = _plain_corr([r[i] for r in rows], [r[j] for r in rows])
            have = got[a, cols[j]]
            assert (want is None) == (have is None), (a, cols[j], want, have)
            assert want is None or math.isclose(want, have, rel_tol=1e-6, abs_tol=1e-9)


def test_correlation_of_few_or_no_rows(spark):
    one = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert [tuple(r) for r in profile.corr_matrix(one).collect()] == [("a", "b", None)]
    assert [tuple(r) for r in profile.corr_matrix(one.filter("a > 5")).collect()] == [("a", "b", None)]
    assert profile.corr_matrix(one, ["a"]).collect() == []
    nan = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, float("nan"), 2.0), (3.0, 1.0, 3.0)], "a double, b double, c double")
    got = {(r.a, r.b): r.r for r in profile.corr_matrix(nan).collect()}
    assert math.isclose(got["a", "c"], 1.0) and (got["a", "b"] is None or math.isnan(got["a", "b"]))


def test_one_scan_for_any_number_of_columns(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    for frame in (profile.corr_matrix(li), profile.cardinality(li, li.columns)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1


def test_cardinality_of_odd_values(spark):
    rows = [(0.0, "a", None, bytearray(b"\x00"), True), (-0.0, "A", None, bytearray(b"\x01"), None), (float("nan"), "", None, bytearray(b"\x00"), True), (float("nan"), None, None, None, False), (None, "a", None, None, None)]
    df = spark.createDataFrame(rows, "x double, s string, n int, b binary, t boolean")
    got = {r.column_name: r.distinct_count for r in profile.cardinality(df, df.columns).collect()}
    assert got == {"x": 2, "s": 3, "n": 0, "b": 2, "t": 2}
    assert {r.distinct_count for r in profile.cardinality(df.limit(0), df.columns).collect()} == {0}
    assert [r.distinct_count for r in profile.cardinality(df, ["s", "s"]).collect()] == [3, 3]


@pytest.mark.parametrize("order", ["frequencyDesc", "alphabetAsc"])
def test_dictionary_equals_the_indexer(spark, order):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(F.col("l_partkey").cast("string").alias("v"), "l_returnflag").repartition(6)
    fitted = features.string_index(["v", "l_returnflag"], order=order).fit(df)
    want = fitted.transform(df).select("v", "l_returnflag", "idx_v", "idx_l_returnflag").distinct()
    got = features.encode(df, ["v", "l_returnflag"], order=order).select("v", "l_returnflag", "idx_v", "idx_l_returnflag").distinct()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    codes = sorted(r.code for r in features.dictionary(df, "v", order).collect())
    assert codes == list(range(len(codes)))


def test_dictionary_of_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None,), ("b",), ("a",), ("b",), ("",)], "`v w` string")
    assert sorted((r.value, r.n, r.code) for r in features.dictionary(df, "v w").collect()) == [("", 1, 1), ("a", 1, 2), ("b", 2, 0)]
    out = features.encode(df, "v w").collect()
    assert sorted((r[0] or "?", r[1]) for r in out) == [("", 1.0), ("?", 3.0), ("a", 2.0), ("b", 0.0), ("b", 0.0)] or len(out) == 5
    assert features.dictionary(df.limit(0), "v w").collect() == []
    assert features.encode(df.limit(0), "v w").columns == ["v w", "idx_v w"]


def test_scatter_equals_ordering_all_rows(spark):
    from tabula.functions.hashing import hash_unit
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    for n, frame in ((1, o), (50, o.repartition(40)), (10**6, o), (20, o.limit(5))):
        want = [r[0] for r in frame.orderBy(hash_unit("o_orderkey", 42), "o_orderkey").limit(n).select("o_orderkey").collect()]
        assert [r[0] for r in charts.scatter_data(frame, ["o_totalprice"], n, "o_orderkey").collect()] == want


def test_scatter_of_repeated_keys_is_still_whole(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), "id")
    assert charts.scatter_data(df, ["id"], 100, "k").count() == 100


def test_drift_report_and_label_free_scoring(spark):
    df = standins.churn_orders_frame(spark, SF_SMALL)
    roles = standins.CHURN_ORDERS_ROLES
    for encode in ("index", "onehot"):
        for missing in ("mean", "skip"):
            model = models.fit(models.build_pipeline(roles, models.estimator("tree", maxDepth=3), encode=encode, label_source="churn", missing=missing), df)
            bare = df.drop("churn")
            want = {r.o_orderkey: r.prediction for r in models.score(model, df).collect()}
            assert {r.o_orderkey: r.prediction for r in models.score(models.label_free(model), bare).collect()} == want
            odd = bare.limit(10).withColumn("o_orderpriority", F.expr("CASE WHEN o_orderkey % 2 = 0 THEN 'new' END")).withColumn("totalprice", F.expr("CASE WHEN o_orderkey % 2 = 0 THEN CAST('NaN' AS DOUBLE) END"))
            even = odd.filter("o_orderkey % 2 = 0").count()
            got = {r.column_name: (r.kind, r.n_rows, r.n_null, r.n_unseen) for r in models.drift_report(model, odd).collect()}
            assert got == {"o_orderpriority": ("category", 10, 10 - even, even), "totalprice": ("number", 10, 10, 0), "order_year": ("number", 10, 0, 0), "order_month": ("number", 10, 0, 0)}


def test_a_label_with_too_many_values_is_refused(spark, monkeypatch):
    from tabula.plans import jobs
    monkeypatch.setattr(jobs, "MOST_CLASSES", 1)
    with pytest.raises(ValueError, match="more than 1 values"):
        jobs.churn_classification(spark, SF_SMALL, "logistic", frame="orders")

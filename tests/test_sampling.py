from pyspark.sql import functions as F

from conftest import SF_MID
from tabula.operators import sampling


def orders(spark):
    return spark.read.parquet(f"{SF_MID}/orders.parquet").select("o_orderkey", "o_orderstatus")


def test_split_disjoint_complete_and_layout_free(spark):
    df = orders(spark)
    parts = sampling.hash_split(df, "o_orderkey", [0.7, 0.3], seed=42)
    n = df.count()
    keys = [set(r.o_orderkey for r in p.collect()) for p in parts]
    assert len(keys[0]) + len(keys[1]) == n and not (keys[0] & keys[1])
    again = sampling.hash_split(df.repartition(7), "o_orderkey", [0.7, 0.3], seed=42)
    assert set(r.o_orderkey for r in again[0].collect()) == keys[0]
    assert 0.66 < len(keys[0]) / n < 0.74


def test_three_way_split_cover(spark):
    df = orders(spark)
    parts = sampling.hash_split(df, "o_orderkey", [1, 1, 2], seed=3)
    assert sum(p.count() for p in parts) == df.count()
    idx = sampling.with_split(df, "o_orderkey", [1, 1, 2], seed=3)
    counts = {r.split: r["count"] for r in idx.groupBy("split").count().collect()}
    assert [counts[i] for i in range(3)] == [p.count() for p in parts]


def test_folds_cover_all_rows(spark):
    df = sampling.with_folds(orders(spark), "o_orderkey", 3, seed=1)
    counts = {r.fold: r["count"] for r in df.groupBy("fold").count().collect()}
    assert set(counts) == {0, 1, 2} and sum(counts.values()) == 15000


def test_stratified_unlisted_class_dropped(spark):
    df = orders(spark)
    out = sampling.stratified_sample(df, "o_orderstatus", {"F": 1.0, "O": 0.1}, "o_orderkey", seed=5)
    got = {r.o_orderstatus: r["count"] for r in out.groupBy("o_orderstatus").count().collect()}
    assert "P" not in got
    assert got["F"] == df.filter("o_orderstatus = 'F'").count()
    assert 0.07 < got["O"] / df.filter("o_orderstatus = 'O'").count() < 0.13


def test_hash_sample_is_a_subset_and_repeatable(spark):
    df = orders(spark)
    a = sampling.hash_sample(df, "o_orderkey", 0.15, seed=42)
    b = sampling.hash_sample(df.repartition(5), "o_orderkey", 0.15, seed=42)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert sampling.hash_sample(df, "o_orderkey", 1.0, seed=42) is df


def test_no_shuffle_in_split(spark):
    df = orders(spark)
    plan = sampling.hash_split(df, "o_orderkey", [0.5, 0.5])[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_null_keys_are_drawn_like_others(spark):
    from pyspark.sql import functions as F
    df = spark.range(300).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("k"), F.col("id").alias("n"), F.lit(None).cast("string").alias("z"))
    for keys in ("k", ["k", "n"], ["k", "z"], "z"):
        parts = sampling.hash_split(df, keys, [0.7, 0.3])
        assert sum(p.count() for p in parts) == 300
        marked = {r.split: r["count"] for r in sampling.with_split(df, keys, [0.7, 0.3]).groupBy("split").count().collect()}
        assert [marked.get(i, 0) for i in range(2)] == [p.count() for p in parts]
        assert sampling.with_folds(df, keys, 3).filter("fold is null").count() == 0
    # a NULL key draws as one key: its rows move together
    assert len({r.split for r in sampling.with_split(df, "k", [0.5, 0.5]).filter("k is null").collect()}) == 1

"""Operator 12 against the plain version: gains, bit-sliced sums, ranks, odd rows."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.llm import importance

from brute import resampled
from llm_fixtures import _library, clashing, edges, nothing, small  # noqa: F401

COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]


def rows_of(frame):
    return [tuple(r) for r in frame.select(*COLUMNS).collect()]


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.mark.parametrize("n,buckets", [(1, 10_000), (2, 997)])
def test_against_plain(spark, small, n, buckets):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    found = importance.resample(small, target, n=n, buckets=buckets)
    docs = [(r["doc_id"], r["text"]) for r in small.collect()]
    want = resampled(docs, [r["text"] for r in target.collect()], n, buckets, 20, 10, 2024)
    assert key(rows_of(found)) == key(want)
    ranks = sorted(r[4] for r in rows_of(found) if r[4])
    assert ranks == list(range(1, len(ranks) + 1)) and ranks


def test_odd_rows(spark, edges, clashing, nothing):
    target = edges.filter("doc_id in (9, 19)")
    docs = [(r["doc_id"], r["text"]) for r in edges.collect()]
    want = key(resampled(docs, [r["text"] for r in target.collect()], 1, 10_000, 20, 50, 2024))
    odd = clashing.withColumn("rank", F.lit(1)).withColumn("weight", F.lit("w")).withColumn("_in", F.lit(True))
    for frame in (edges, odd):
        found = key(rows_of(importance.resample(frame, target, percent=50)))
        # rows that share an id and a score may change ranks
        assert [r[:4] for r in found] == [r[:4] for r in want] and sorted(r[4] or 0 for r in found) == sorted(r[4] or 0 for r in want)
    assert rows_of(importance.resample(nothing, target)) == []
    alone = rows_of(importance.resample(edges, nothing, percent=100))
    assert key(alone) and {r[4] is None for r in alone if r[1] == 0} == {True}
    assert all(r[4] is None for r in rows_of(importance.resample(edges, target, percent=0)))


def test_ranks_of_many_equal_rows(spark):
    same = "a b c d e f g h i j k l m n o p q r s t u"
    docs = spark.range(400).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit(same).alias("text"))
    found = rows_of(importance.resample(docs, docs, percent=100))
    assert sorted(r[4] for r in found) == list(range(1, 401))
    assert [r[3] for r in sorted(found, key=lambda r: r[4])] == sorted((r[3] for r in found), reverse=True)


def test_bit_planes_sum_exactly():
    rnd = np.random.default_rng(7)
    for buckets in (1, 63, 64, 130):
        gain = rnd.integers(-5000, 3000, buckets)
        found = rnd.integers(0, buckets, 5000)
        rows = np.sort(rnd.integers(0, 9, 5000))
        want = np.bincount(rows, gain[found].astype(float), 9).astype(int)
        assert (importance.weigh(rows, found, 9, importance.gain_planes(gain), buckets) == want).all()
    for gain in ([0, 0], [-1, -1], [-8, 7], [-9, 8], [5, 3]):
        planes = importance.gain_planes(np.array(gain))
        assert importance.weigh(np.array([0, 0, 1]), np.array([0, 1, 1]), 2, planes, 2).tolist() == [sum(gain), gain[1]]

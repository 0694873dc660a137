"""Chunks of bounded size whatever the ids and lengths; window exchange through relays, messages linear in the input."""
import brute
import numpy as np
import pytest
from llm_fixtures import SF_SMALL, _library, clashing, edges, nothing, small  # noqa: F401
from pyspark.sql import functions as F

from tabula.llm import common, substring


def _sizes(placed):
    rows = placed.groupBy("chunk").agg(F.sum(F.octet_length("text")).alias("b"), F.max(F.octet_length("text")).alias("m"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n"))
    return {r["chunk"]: r for r in rows.collect()}


def test_chunks_are_cut_by_bytes(spark):
    # five hundred long documents side by side, the others short
    long = F.when((F.col("id") >= 1000) & (F.col("id") < 1500), 10_000).otherwise(20)
    docs = spark.range(20_000).select((F.col("id") + 2**60).alias("doc_id"), F.repeat(F.lit("x"), long.cast("int")).alias("text")).repartition(7)
    placed, size = common.chunked(docs, 100_000)
    found = _sizes(placed)
    assert size == sum(r["b"] for r in found.values()) == 500 * 10_000 + 19_500 * 20 and sum(r["n"] for r in found.values()) == 20_000
    assert max(r["b"] for r in found.values()) <= 2 * 100_000 and len(found) >= 40, [(c, r["b"]) for c, r in sorted(found.items())]
    spans = sorted((c, r["lo"], r["hi"]) for c, r in found.items())
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))  # consecutive ids


def test_rows_without_id_are_spread(spark):
    docs = spark.range(50_000).select(F.when(F.col("id") < 100, F.col("id")).alias("doc_id"), F.lit("the same text").alias("text"))
    found = _sizes(common.chunked(docs, 10_000)[0])
    assert sum(r["n"] for c, r in found.items() if c < 0) == 49_900 and found[0]["n"] == 100
    assert max(r["b"] for r in found.values()) <= 2 * 10_000


def test_ids_must_be_numbers(spark):
    with pytest.raises(TypeError, match="numbers"):
        common.chunked(spark.createDataFrame([("a", "b")], "doc_id string, text string"), 10)


def test_one_id_and_nothing(spark, nothing):
    assert common.chunked(nothing, 10)[0].count() == 0
    docs = spark.createDataFrame([(5, "abc"), (5, "def"), (6, None)], "doc_id long, text string")
    found = _sizes(common.chunked(docs, 1)[0])
    assert sum(r["n"] for r in found.values()) == 3


@pytest.mark.parametrize("fan_bits,bucket_windows", [(1, 200), (2, 50), (10, 1 << 20)])
def test_relays_give_the_same_rows(spark, edges, small, fan_bits, bucket_windows):
    for docs in (edges, small):
        made = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        want = sorted(map(repr, brute.repeats(made, 10)))
        got = substring.remove_repeats(docs, 10, chunk_bytes=2000, bucket_windows=bucket_windows, fan_bits=fan_bits)
        rows = got.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("d")).collect()
        assert sorted(repr(tuple(r)) for r in rows) == want
    if fan_bits == 1:
        size = small.agg(F.sum(F.octet_length("text"))).first()[0]
        assert len(substring.exchange_levels(size, bucket_windows, fan_bits)) > 5


def test_messages_grow_with_the_input():
    gb = 1 << 30
    for size in (gb, 10 * gb, 100 * gb, 10_000 * gb):
        levels = substring.exchange_levels(size)
        chunks = size / max(substring.CHUNK_BYTES, size / common.MOST_CHUNKS)
        # a chunk, and a relay for every range and group of as many chunks, send a message a range at most
        steps = np.diff([0, *levels])
        sent = sum(chunks / 2 ** (k * substring.FAN_BITS) * 2 ** levels[k] for k in range(len(levels)))
        assert max(steps) <= substring.FAN_BITS and sent / (size / gb) <= len(levels) * 65536, (size, levels, sent / (size / gb))
    assert substring.exchange_levels(0) == [0] and substring.exchange_levels(gb) == [8]

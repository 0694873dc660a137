"""Operator 11 against the plain version: every near pair, lists parted down to one place, slips, chains, odd rows."""
import random

import pytest
from pyspark.sql import functions as F

from tabula.llm import variants

from brute import near, slipped, variants as plain
from llm_fixtures import _library, clashing, edges, nothing  # noqa: F401

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def grouped(spark, counts, limit):
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    return {r[0]: tuple(r[1:]) for r in variants.group(rows, limit=limit).select(*COLUMNS).collect()}


def dense(seed, letters, lengths, number):
    rnd = random.Random(seed)
    return {"".join(rnd.choice(letters) for _ in range(rnd.choice(lengths))): rnd.choice([5, 6, 25, 30, 130, 700]) for _ in range(number)}


@pytest.mark.parametrize("limit", [variants.LIST, 3])
@pytest.mark.parametrize("made", [dense(1, "ab", (6, 7, 8), 300), dense(2, "abcéÿ\U0001F600", (1, 2, 3), 150), dense(3, "abcdefgh", (6, 7), 400)])
def test_every_near_pair_comes_out_once(spark, made, limit):
    assert grouped(spark, made, limit) == plain(made, 5)


def test_a_common_front_is_parted(spark):
    # all words share most of their letters at one end, so halves alone stay whole
    made = {"x" * 40 + w: n for w, n in dense(4, "abcdef", (3, 4), 250).items()} | {w + "y" * 40: n for w, n in dense(5, "abcdef", (3, 4), 250).items()}
    assert grouped(spark, made, 8) == plain(made, 5)
    words = spark.createDataFrame(list(made.items()), "word string, n long")
    sizes = variants.lists(words, 8).groupBy(*variants._KEY).agg(F.count("word").alias("size"))
    assert sizes.filter("hi - lo > 1").agg(F.max("size")).first()[0] <= 8


def test_long_words(spark):
    long = "q" * 3000 + "z" * 2000
    made = {long: 50, long[:-1]: 5, "p" + long: 7, long[:2000] + "r" + long[2001:]: 300, "other": 9}
    assert grouped(spark, made, variants.LIST) == plain(made, 5)


def test_chains_end_at_the_most_frequent(spark):
    made = {"abcdef" + "x" * k: 5 ** (9 - k) for k in range(9)}
    found = grouped(spark, made, variants.LIST)
    assert {x[1] for x in found.values()} == {"abcdef"}
    assert found == plain(made, 5)


def test_ties_and_odd_words(spark):
    rows = spark.createDataFrame([("abcdex", 10), ("abcdey", 10), ("abcdez", 2), (None, 9), ("", 9), ("abcdez", 0)], "word string, n long")
    found = {r["word"]: r for r in variants.group(rows).collect()}
    assert set(found) == {"abcdex", "abcdey", "abcdez"}
    assert (found["abcdez"]["form"], found["abcdez"]["form_n"], found["abcdez"]["n_near"], found["abcdex"]["form"]) == ("abcdex", 10, 2, None)


def test_vocabulary_of_odd_rows(spark, edges, clashing, nothing):
    made = [(r["doc_id"], r["text"]) for r in edges.collect()]
    for slip in (199, 2, 1):
        want = slipped(made, slip, 6, 2)
        for docs in (edges, clashing.withColumn("word", F.lit(1)).withColumn("n", F.lit(1)).withColumn("run", F.lit("a")).withColumn("id", F.lit(0))):
            assert {r["word"]: r["n"] for r in variants.vocabulary(docs, slip=slip, least_count=2).collect()} == want
    assert variants.group(variants.vocabulary(nothing)).collect() == []
    assert variants.group(variants.vocabulary(edges.withColumn("text", F.lit(None).cast("string")))).collect() == []


def test_scan_agrees_with_pairs():
    import numpy as np

    words = sorted(dense(6, "abc", (4, 5), 120))
    none = np.zeros(len(words), int)
    for cls in (4, 5):
        q, w = variants.scan(words, none, none + cls, none, none + cls + 1)
        got = {(words[a], words[b]) for a, b in zip(q, w)}
        assert got == {(a, b) for a in words for b in words if len(a) == cls and len(b) in (cls, cls + 1) and near(a, b)}
        assert len(q) == len(got)

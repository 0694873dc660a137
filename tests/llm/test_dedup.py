"""Operators 3, 6, 7: windows, vectors, min-max signatures against brute force."""

import brute
import corpus_pipeline
import numpy as np
import pytest
from llm_fixtures import SF_SMALL, _library, clashing, edges, nothing, small  # noqa: F401

from tabula.llm import common, components, embed_join, minmax, queries, substring


def _by_id(rows):
    return {r["doc_id"]: r for r in rows}


def _distinct(edges):
    """Rows with an id of their own, as (doc_id, text)."""
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    ids = [d for d, _ in rows]
    return [(d, t) for d, t in rows if d is not None and ids.count(d) == 1]


def test_min_and_max_estimate_without_bias():
    rng = np.random.default_rng(1)
    masks, factors = rng.integers(0, 1 << 32, (2, minmax.PERMUTATIONS), np.uint32)
    factors |= np.uint32(1)
    share = []
    for _ in range(40):
        x = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
        a, b = minmax._signature(x[:800], masks, factors), minmax._signature(x[200:], masks, factors)
        share.append((a == b).mean())
    assert abs(np.mean(share) - 0.6) < 0.02


def test_band_rows_keep_misses_rare():
    for percent in (50, 80, 85, 95):
        r = minmax.band_rows(percent)
        assert (1 - (percent / 100) ** r) ** (minmax.VALUES // r) <= 1e-8


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(spark, edges, small, n, percent):
    for docs in (_distinct(edges), [(r["doc_id"], r["text"]) for r in small.collect()]):
        got = _by_id(minmax.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), n, percent).collect())
        want = brute.near_duplicates(docs, n, percent)
        assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == want
        assert all(r["kept"] == (d == r["component_id"]) for d, r in got.items())


def test_a_chain_of_near_copies_is_one_component(spark):
    """Neighbours are alike, the ends are not: links between members that no hub sees must count."""
    words = [f"w{i}" for i in range(400)]
    docs = []
    for k in range(30):
        own = [f"x{i}" if i < 8 * k else w for i, w in enumerate(words)]
        docs.append((100 - k, " ".join(own)))
    got = minmax.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 3, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {d: c for d, (_, c) in brute.near_duplicates(docs, 3, 85).items()}
    assert {r["component_id"] for r in got} == {71}


def test_near_duplicates_of_odd_rows(edges, clashing, nothing):
    rows = minmax.near_duplicates(clashing).collect()
    assert len(rows) == clashing.count() and minmax.near_duplicates(nothing).count() == 0
    assert all(r["component_id"] is None and r["kept"] for r in rows if r["doc_id"] is None)
    seven = [r for r in rows if r["doc_id"] == 7]  # an id with two texts has the links of both
    assert len(seven) == 2 and all(r["component_id"] == 5 for r in seven if r["n_shingles"] > 5)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(3, 3)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert set(got.values()) == {7, 100} and got[140] == 100 and got[259] == 7


@pytest.mark.parametrize("chunk_bytes", [1000, 1 << 20])
def test_window_removal_matches_brute_force(spark, edges, small, chunk_bytes):
    from pyspark.sql import functions as F

    for docs in (edges.select("doc_id", "text"), small.select("doc_id", "text")):
        out = substring.remove_repeats(docs, 50, chunk_bytes, 5000).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("h"))
        got = sorted((tuple(r) for r in out.collect()), key=repr)
        assert got == sorted(brute.repeats([tuple(r) for r in docs.collect()], 50), key=repr)


def test_window_removal_of_clashing_columns_and_nothing(clashing, nothing, edges):
    assert substring.report(nothing).count() == 0
    assert sorted(map(repr, substring.report(clashing).collect())) == sorted(map(repr, substring.report(edges).collect()))


def test_sorted_packing_round_trip():
    for values in ([], [0], [5, 5, 5], [1, 2**63, 2**64 - 1]):
        x = np.array(values, np.uint64)
        assert (substring.unpack_sorted(substring.pack_sorted(x)) == x).all()


def _vectors():
    rng = np.random.default_rng(3)
    ball = rng.normal(size=16)
    rows = [(i, 1, (ball + 0.05 * rng.normal(size=16)).tolist()) for i in range(120)]
    rows += [(200 + i, i % 3, rng.normal(size=16).tolist()) for i in range(150)]
    rows += [(400, 1, rows[0][2]), (401, 2, rows[0][2]), (402, None, rows[0][2]), (403, 1, None), (404, 1, [0.0] * 16), (405, 1, [float("nan")] * 16),
             (406, 1, [None] + [1.0] * 15), (407, 1, [float("inf")] * 16), (408, 1, [1.0, 2.0]), (409, 1, [2.0, 4.0]), (410, 1, []), (411, 1, [1e200] * 2), (412, 1, [3e200] * 2)]
    return rows


@pytest.mark.parametrize(("cell", "block"), [(4000, 3000), (50, 20)])
def test_range_join_matches_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(embed_join, "CELL", cell)
    monkeypatch.setattr(embed_join, "BLOCK", block)
    rows = _vectors()
    got = embed_join.range_join(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == brute.links(rows, 0.98)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_range_join_of_odd_rows(spark):
    rows = [(None, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 1, [1.0, 0.01])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr("*", "'a' as cell", "1 as n_links")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in embed_join.range_join(frame).collect())
    assert got == [(0, 0, None), (1, 2, 1), (1, 2, 1), (2, 2, 1)]
    assert embed_join.range_join(frame.limit(0)).count() == 0


def test_query_over_embeddings(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    got = queries.op6_pivot_range_join(spark, SF_SMALL).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == brute.links(rows, 0.98)


@pytest.mark.parametrize("bits", [64, 1 << 23])
def test_without_drops_exactly_the_keys_gone(spark, clashing, monkeypatch, bits):
    # few places: rows that stay share theirs with rows that go
    monkeypatch.setattr(common, "MARK_BITS", bits)
    docs = clashing.withColumns({"row": clashing["text"], "word": clashing["doc_id"], "marked": clashing["lang"]})
    gone = docs.filter("doc_id % 3 = 0")
    got = common.without(docs, gone.unionAll(gone), "doc_id")
    assert got.columns == docs.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, docs.filter("doc_id is null or doc_id % 3 <> 0").collect()))
    assert common.without(docs, docs.limit(0), "doc_id").count() == docs.count()
    assert sorted(map(repr, common.within(docs, gone.unionAll(gone), "doc_id").collect())) == sorted(map(repr, gone.collect()))


def test_rows_that_stay_are_not_shuffled(spark, small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = corpus_pipeline.drop_near_duplicates(spark, small, SF_SMALL)._jdf.queryExecution().sparkPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    while plan.nodeName() != "Union" and plan.children().size():
        plan = plan.children().head()
    assert plan.nodeName() == "Union"
    stay, unsure = (plan.children().apply(k).toString() for k in range(2))
    assert "SortMergeJoin" not in stay and "LeftAnti" in unsure


def test_bands_are_dealt_by_key_once_and_only_asked_sets_move(small, monkeypatch):
    plans = {}

    def noted(df, name, *more):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return common.write_scratch(df, name, *more)

    monkeypatch.setattr(minmax, "write_scratch", noted)
    minmax.near_duplicates(small).count()
    assert plans["minmax-buckets"].count("Exchange hashpartitioning(key") == 1
    assert "LeftSemi" in plans["minmax-more"]
    # texts that share no bucket leave before the shuffle
    texts = plans["minmax-sets"]
    assert "BroadcastHashJoin [word" in texts and "LeftSemi" in texts

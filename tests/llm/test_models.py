"""Operators 2, 4, 8, 9: spans and counts against brute force, models on held-out rows."""

import hashlib

import brute
import numpy as np
from llm_fixtures import SF_SMALL, _library, clashing, edges, nothing, prose, small  # noqa: F401
from pyspark.sql import functions as F

from tabula.llm import langid, quality, queries, rules, secret_scan

SF = "/root/testdata/sf0.01"


def test_base_spans_match_brute_force(spark, edges, small):
    for docs in (edges, small, spark.read.parquet(f"{SF}/documents.parquet")):
        got = secret_scan.report(docs, None).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans").collect()
        want = []
        for r in docs.select("doc_id", "text").collect():
            spans = brute.base_spans(r["text"])
            listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
            want.append((r["doc_id"], *(sum(s[1] == k for s in spans) for k in range(3)), hashlib.sha256(listed.encode()).hexdigest(), listed))
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_markov_ratio_matches_plain_code(spark, small):
    model = secret_scan.model_for(small)
    strings = ["4f9Kd0Zq81LmW2xYb7Rt", "ordinary_identifier_name", "a", "", "é-漢字-x"]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in strings], "s string").select(secret_scan.ratio(F.col("s"), model)).collect()]
    side = len(secret_scan.ALPHABET) + 1
    for s, x in zip(strings, got, strict=True):
        places = [secret_scan.ALPHABET.find(c) + 1 for c in s]
        steps = [round(model[a * side + b], 5) for a, b in zip(places, places[1:])]
        assert abs(x - sum(steps) / max(len(steps), 1)) < 1e-9
    assert got[0] > secret_scan.MARGIN > got[1]


def test_markov_finds_random_keys_and_leaves_words(spark, small):
    model = secret_scan.model_for(small)
    random_ = [hashlib.sha256(str(i).encode()).hexdigest()[:30].upper() for i in range(200)]
    plain = [prose(i, 30).replace(" ", "_").replace(".", "").replace(",", "")[:40] + "_v2" for i in range(200)]
    docs = spark.createDataFrame([(i, f"see {s} here") for i, s in enumerate(random_ + plain)], "doc_id long, text string")
    hits = {r["doc_id"] for r in secret_scan.report(docs, model).filter("spans like '%markov%'").collect()}
    assert sum(i < 200 for i in hits) >= 190 and sum(i >= 200 for i in hits) <= 4


def test_added_spans_keep_base_spans_and_redaction_covers_all(edges, small):
    model = secret_scan.model_for(small)
    for r in secret_scan.scan(edges, model).withColumn("clean", secret_scan.redact(F.col("text"), F.col("spans"))).collect():
        assert set(r["base_spans"]) <= set(r["spans"])
        if not r["spans"]:
            assert r["clean"] == r["text"]
            continue
        want, at = "", 0
        for s in r["spans"]:
            if s["start"] >= at:
                want += r["text"][at:s["start"]] + "[SECRET]"
            at = max(at, s["end"])
        assert r["clean"] == want + r["text"][at:]


def test_secret_scan_uses_no_python_on_its_path(small):
    plan = secret_scan.report(small, [0.0] * (len(secret_scan.ALPHABET) + 1) ** 2)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_secret_scan_of_clashing_columns_and_nothing(clashing, nothing, edges):
    assert secret_scan.report(nothing, secret_scan.model_for(nothing)).count() == 0
    assert sorted(map(repr, secret_scan.report(clashing, None).collect())) == sorted(map(repr, secret_scan.report(edges, None).collect()))


def test_rule_counts_match_brute_force(edges, small, clashing):
    for docs in (edges, small, clashing):
        got = rules.statistics(docs).select("doc_id", *rules.COUNTS).collect()
        want = [(r["doc_id"], *brute.rule_counts(r["text"])) for r in docs.select("doc_id", "text").collect()]
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_forest_paths_follow_the_trees():
    rng = np.random.default_rng(0)
    rows = np.concatenate([rng.normal(size=(500, 3)), [[9.0, 9.0, 9.0]]])
    forest = rules.grow(rows)
    score = rules.anomaly(forest, rows)
    assert score.argmax() == 500 and 0 < score.min() and score.max() < 1
    for row in rows[:5]:
        total = 0.0
        for t in range(len(forest.column)):
            node = 0
            while forest.column[t, node] >= 0:
                node = forest.left[t, node] + (row[forest.column[t, node]] > forest.value[t, node])
            total += forest.path[t, node]
        assert abs(rules.anomaly(forest, row[None])[0] - 2 ** -(total / len(forest.column) / forest.norm)) < 1e-12


def test_forest_fails_junk_and_keeps_good(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in queries.op4_forest_rules(spark, SF).collect() if r["doc_id"] in labels]
    assert all(not r["kept"] for r in rows if r["base_failed"])
    passed = [r for r in rows if not r["base_failed"]]
    good = [r["kept"] for r in passed if labels[r["doc_id"]] == 1]
    bad = [r["kept"] for r in passed if labels[r["doc_id"]] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.5


def test_rules_without_labels_or_rows(spark, edges, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = rules.judge(edges, labels).collect()
    assert len(rows) == edges.count() and all(r["kept"] != r["base_failed"] for r in rows)
    assert rules.judge(nothing, labels).count() == 0


def test_language_filters_on_held_out_rows(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in queries.op8_bitmask_langid(spark, SF).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_masks_hold_every_inserted_gram():
    rng = np.random.default_rng(2)
    own = [rng.integers(0, 1 << 63, 500).astype(np.uint64) for _ in range(70)]  # more languages than one plane
    planes = np.zeros((2, 1 << langid.SLOT_BITS), np.uint64)
    for k, hashed in enumerate(own):
        for slot in langid._slots(hashed):
            planes[k // 64][slot] |= np.uint64(1 << (k % 64))
    filled = np.array([(planes[k // 64] >> np.uint64(k % 64) & np.uint64(1)).mean() for k in range(70)])
    model = langid.Model([f"l{k:02}" for k in range(70)], planes, filled ** langid.HASHES, 0)
    found = langid.Grams(np.concatenate([own[3], own[69]]), np.array([0, 500, 1000, 1000]), np.array([1, 1, 0]))
    share = langid.shares(found, model)
    assert share[0].argmax() == 3 and share[1].argmax() == 69 and share[0, 3] == share[1, 69] == 1 and np.delete(share[0], 3).max() < 0.02
    assert not share[2].any()


def test_language_of_odd_rows(spark, edges, clashing, nothing):
    model = langid.train(edges)
    rows = langid.identify(clashing, model).collect()
    assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) for r in rows)
    assert {r["lang_pred"] for r in rows} <= {"und", *model.langs} and langid.identify(nothing, model).count() == 0
    none = langid.train(nothing)
    assert {r["lang_pred"] for r in langid.identify(edges, none).collect()} == {"und"}


def test_quality_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in queries.op9_indexing_quality(spark, SF).collect() if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in rows]) > 0.9
    chance = np.array([r["score"] for r in rows])
    truth = np.array([labels[r["doc_id"]] for r in rows])
    assert abs(chance.mean() - truth.mean()) < 0.08  # calibrated on the whole


def test_units_of_a_batch_are_those_of_single_texts():
    import pyarrow as pa

    texts = ["THE!! end", "", None, "a longword7 été\n|x", "###"]
    whole, first = quality.units(pa.array(texts, pa.string()))
    for k, t in enumerate(texts):
        assert whole[first[k]:first[k + 1]].tolist() == quality.units(pa.array([t], pa.string()))[0].tolist()


def test_temperature_tames_overconfidence():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 8))
    y = (x[:, 0] + rng.normal(size=400) > 0).astype(float)
    net = quality.fit_network(x, y)
    assert net.temperature > 1 and np.mean((net.chance(x) >= 0.5) == (y == 1)) > 0.6


def test_quality_without_labels_or_rows(spark, edges, nothing, clashing):
    labels = spark.createDataFrame([(5, 1), (9, 1), (None, 0), (99, 0)], "doc_id long, quality int")
    model = quality.train(clashing, labels)
    assert {r["score"] for r in quality.score(clashing, model).collect()} == {1.0}
    assert {r["score"] for r in quality.score(edges, quality.train(edges, labels.limit(0))).collect()} == {0.5}
    assert quality.score(nothing, model).count() == 0
    both = quality.train(edges, spark.createDataFrame([(5, 1), (14, 0), (9, 1), (10, 1), (13, 0)], "doc_id long, quality int"))
    assert all(0 <= r["score"] <= 1 for r in quality.score(edges, both).collect())

"""Operators 1, 5, 10 and the pipeline: balance, round trips, gapless packing."""

import zlib
from collections import Counter, defaultdict

import brute
import corpus_pipeline
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF_SMALL, _library, clashing, edge_rows, edges, nothing, small  # noqa: F401
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tabula.llm import langid, mixing, packing, queries, rangecoder, token_files, tokens
from tabula.session import scratch_path

LIB = Tokenizer.from_file(tokens.default_vocabulary())


def _ids(text, end):
    return [*LIB.encode(text or "", add_special_tokens=False).ids, end]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def _plain_targets(sizes, weights, share, most):
    """Reshare step by step, as the contract words it."""
    order = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_, left = {}, set(order), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def test_mix_targets_sizes_and_totals(spark, small, edges):
    for docs in (small, edges, spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        rows = mixing.mix(mixing.sized(docs)).collect()
        texts = [(r["doc_id"], r["source"], len(brute.words(r["text"]))) for r in docs.collect()]
        assert sorted(map(repr, ((r["doc_id"], r["source"], r["size"]) for r in rows))) == sorted(map(repr, texts))
        sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
        for _, s, n in texts:
            sizes[s] += n
            largest[s] = max(largest[s], n)
        want = _plain_targets(sizes, (3, 1, 2), 1.5, 2.0)
        for r in rows:
            assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]])
            assert r["taken"] in (0, r["size"], 2 * r["size"])
            taken[r["source"]] += r["taken"]
        for s in sizes:
            assert abs(taken[s] - want[s]) <= max(0.05 * want[s], largest[s])


def test_mix_agrees_between_runs_and_layouts(small):
    one = {r["doc_id"]: r["taken"] for r in mixing.mix(mixing.sized(small)).collect()}
    other = {r["doc_id"]: r["taken"] for r in mixing.mix(mixing.sized(small.repartition(7))).collect()}
    assert one == other


def test_mix_in_small_blocks_still_meets_targets(spark):
    rows = [(i, "abc"[i % 3], int(x)) for i, x in enumerate(np.random.default_rng(0).integers(1, 500, 3000))]
    units = spark.createDataFrame(rows, "doc_id long, source string, size long")
    taken, count, target = defaultdict(int), defaultdict(float), {}
    for r in mixing.mix(units, block=60).collect():
        taken[r["source"]] += r["taken"]
        count[r["source"]] += r["copies"] - r["target"] / r["source_size"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) < 0.002 * target[s] for s in target)
    assert all(abs(c) < 12 for c in count.values())  # documents balance too


def test_flight_keeps_totals_and_chances():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 100, 60)
    mean = np.zeros(60)
    for k in range(400):
        out = mixing.fly(sizes.tolist(), np.full(60, 0.3), np.random.default_rng(k).random(60))
        assert abs(out @ sizes - 0.3 * sizes.sum()) < 1e-6 and abs(out.sum() - 18) < 1e-9
        assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2
        mean += out / 400
    assert np.abs(mean - 0.3).max() < 0.12


def test_mix_of_nothing(nothing, clashing):
    assert mixing.mix(mixing.sized(nothing)).count() == 0
    assert mixing.mix(mixing.sized(clashing)).count() == clashing.count()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.integers(1, 64), st.sampled_from([1, 7, 300, 2**32]))
def test_coder_round_trip(ids, block, span):
    ids = np.array([i % span for i in ids], "<u4")
    raw = rangecoder.write_file(ids, block)
    assert (rangecoder.read_file(raw) == ids).all()


def test_coder_learns_and_detects_damage():
    ids = np.tile(np.arange(500, dtype="<u4"), 40)
    raw = rangecoder.write_file(ids)
    assert len(raw) < len(ids) // 2  # orders 1 and 2 know what follows
    rng = np.random.default_rng(0)
    noise = rng.integers(0, 2000, 20_000).astype("<u4")
    assert len(rangecoder.write_file(noise)) * 8 < 20_000 * 11.6 + 8 * 9000
    for at in (len(raw) // 2, len(raw) - 40, 30):
        bad = bytearray(raw)
        bad[at] ^= 0x55
        with pytest.raises(ValueError):
            rangecoder.read_file(bytes(bad))


def test_cached_ids_are_those_of_whole_texts(small):
    encoder = tokens.ChunkTokenizer(tokens.default_vocabulary(), limit=50)
    odd = ["Ḧ̱a İı ſΣς", "<|endoftext|> <|ENDOFTEXT|>", "it's IT'S. a's.", "x'. ab.. é. É, ß.", "a\x85b\xa0c　d", "中文\U0001F600"]
    for text in [r["text"] or "" for r in small.collect()] + odd + [r[1] or "" for r in edge_rows()]:
        assert encoder.encode(text).tolist() == _ids(text, 0)[:-1]


def test_cache_keeps_what_it_found_last_when_it_is_full(monkeypatch):
    encoder = tokens.ChunkTokenizer(tokens.default_vocabulary(), limit=1)
    want = encoder.encode("alpha Beta").tolist()
    monkeypatch.setattr(tokens._Chunks, "__missing__", lambda self, chunk: self.older[chunk])  # no look-ups in the vocabulary
    assert encoder.encode("beta alpha beta").tolist() == _ids("beta alpha beta", 0)[:-1]
    assert len(encoder.chunks.older) == len(want) == 2 and not encoder.chunks.older.older


@pytest.mark.parametrize("file_bytes", [2000, 1 << 20])
def test_token_files_round_trip(spark, small, clashing, file_bytes):
    for docs in (small, clashing):
        path = scratch_path(spark, "test-tokens")
        token_files.write_tokens(docs, path, file_bytes=file_bytes)
        got = sorted((tuple(r) for r in token_files.read_tokens(spark, path).collect()), key=lambda r: r[1])
        # rows that share an id follow each other by their ids' bytes; rows without one come first
        rows = sorted(((r["doc_id"], _ids(r["text"], 1)) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], "<u2").tobytes()))
        at, want = 0, []
        for doc, ids in rows:
            want.append((doc, at, len(ids), _crc(ids)))
            at += len(ids)
        assert got == want


def test_token_files_of_nothing(spark, nothing):
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(nothing, path)
    assert token_files.read_tokens(spark, path).count() == 0


def _check_packing(rows, docs, end, capacity):
    """Pieces are the documents' ids in order; sequences are gapless and not too long."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    want = defaultdict(list)
    for doc, text in docs:
        ids = _ids(text, end)
        want[doc] += [(n, at, len(ids[at:at + capacity]), _crc(ids[at:at + capacity])) for n, at in enumerate(range(0, len(ids), capacity))]
    assert {d: sorted(x) for d, x in by_doc.items()} == {d: sorted(x) for d, x in want.items()}
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), sum(r["length"] for r in rows)


def test_packing_is_whole_and_tight(small, edges, clashing):
    for docs in (small, edges, clashing):
        rows = packing.pack(packing.pieces(docs)).collect()
        n, total = _check_packing(rows, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], 0, 2048)
        assert n <= -(-total // 2048) + 1


def test_packing_in_groups(small, nothing):
    rows = packing.pack(packing.pieces(small, capacity=64), capacity=64, group=100).collect()
    n, total = _check_packing(rows, [(r["doc_id"], r["text"]) for r in small.select("doc_id", "text").collect()], 0, 64)
    assert n <= 1.02 * total / 64 + 1
    assert packing.pack(packing.pieces(nothing)).count() == 0


def test_search_empties_bins_that_best_fit_leaves():
    lengths = np.array([6, 6, 5, 5, 4, 4, 3, 3, 2, 2])  # 40: four bins of ten
    assert len(packing.improve([[0, 8], [1, 9], [2, 6], [3, 7], [4, 5]], lengths, 10)) == 4
    rng = np.random.default_rng(0)
    better = 0
    for _ in range(60):
        lengths = rng.integers(20, 60, 60)
        first = packing.best_fit(lengths, 100)
        after = packing.improve([list(b) for b in first], lengths, 100)
        assert sorted(i for b in after for i in b) == list(range(60)) and all(lengths[b].sum() <= 100 for b in after)
        better += len(after) < len(first)
        assert len(after) <= len(first)
    assert better


def test_pipeline_stages(spark, edges, small, clashing, nothing):
    """Each stage against a plain version of its decision, on its own input."""
    for docs in (edges, small, clashing, nothing):
        start = docs
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF_SMALL)
            rows, before = out.collect(), docs.collect()
            if k < 4:
                assert out.columns == start.columns and out.dtypes == start.dtypes, name
            if k == 0 and before:
                model = langid.train(docs.select("doc_id", "text", "lang"))
                judged = [(r, brute.language(r["text"], model)) for r in before]
                want = [r for r, (lang, share) in judged if lang != "und" and share >= corpus_pipeline.LEAST_KNOWN]
                assert sorted(map(repr, rows)) == sorted(map(repr, want))
            elif k == 1:
                named = [(r["doc_id"], r["text"]) for r in before if r["doc_id"] is not None]
                if len({d for d, _ in named}) == len(named):
                    want = {d for d, (_, c) in brute.near_duplicates(named, 5, 80).items() if d == c}
                    assert {r["doc_id"] for r in rows if r["doc_id"] is not None} == want
            elif k == 2:
                assert len(rows) == len(before)
                assert not any(brute.base_spans(r["text"]) for r in rows)
                clean = {repr(r) for r in before if not brute.base_spans(r["text"])}
                assert len(clean & {repr(r) for r in rows}) >= 0.98 * len(clean)
            elif k == 3:
                times, had = Counter(map(repr, rows)), Counter(map(repr, before))
                assert all(times[x] <= 2 * had[x] for x in times)
                sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
                for r in before:
                    sizes[r["source"]] += len(brute.words(r["text"]))
                    largest[r["source"]] = max(largest[r["source"]], len(brute.words(r["text"])))
                for r in rows:
                    taken[r["source"]] += len(brute.words(r["text"]))
                want = _plain_targets(sizes, (3, 1, 2), 1.5, 2.0)
                assert all(abs(taken[s] - want[s]) <= max(0.01 * want[s], largest[s]) for s in sizes)
            elif k == 4:
                _check_packing(rows, [(r["doc_id"], r["text"]) for r in before], 0, 2048) if len({r["doc_id"] for r in before}) == len(before) else None
            docs = spark.createDataFrame(rows, out.schema)


def test_pipeline_and_every_operator_are_registered(spark):
    names = entry.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    assert set(queries.QUERIES) <= set(names)
    assert names["pipeline"](spark, SF_SMALL).count() > 0

"""Operator 13 against the tokenizer on whole texts, and its cache."""
import pytest
from pyspark.sql import functions as F

from tabula.llm import token_counts

from llm_fixtures import _library, clashing, edges, nothing, prose, small  # noqa: F401

ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "▁", "▁▁a▁", "a▁ b", "x\n y\t z", "<s> </s> <unk><0x0A>", "a\x00b \x00", "été ÉTÉ \U0001F600 中文 字", "12 345  6", "﻿a ", " " * 100 + "b" + " " * 37]


def whole(texts, vocabulary):
    if vocabulary.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        return [len(model.encode(t)) for t in texts]
    from tokenizers import Tokenizer
    return [len(e.ids) for e in Tokenizer.from_file(vocabulary).encode_batch(texts, add_special_tokens=False)]


def vocabularies():
    import public_tokenizers
    return [public_tokenizers.path(n) for n in ("piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.json")]


@pytest.mark.parametrize("vocabulary", vocabularies())
def test_segments_add_up_to_whole_texts(small, vocabulary):
    texts = ODD + [r["text"] for r in small.collect()] + [prose(8, 4000)]
    assert token_counts.counter(vocabulary)(texts) == whole(texts, vocabulary)


@pytest.mark.parametrize("vocabulary", vocabularies())
def test_rows_and_bytes(spark, edges, clashing, nothing, tmp_dir, vocabulary):
    made = [(r["doc_id"], r["text"] or "") for r in edges.collect()] + [(-1 - i, t) for i, t in enumerate(ODD)]
    counts = whole([t for _, t in made], vocabulary)
    want = sorted(((d is None, d or 0), len(t.encode()), n, n > 100) for (d, t), n in zip(made, counts))
    extra = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    odd = clashing.withColumn("digest", F.lit("x")).withColumn("n_tokens", F.lit(3))
    for k, docs in enumerate((edges, odd)):
        found = token_counts.count_tokens(docs.unionByName(extra, allowMissingColumns=True), f"{tmp_dir}/{k}", vocabulary, limit=100)
        assert sorted(((r[0] is None, r[0] or 0), r[1], r[2], r[3]) for r in found.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()) == want
    assert token_counts.count_tokens(nothing, f"{tmp_dir}/none", vocabulary).collect() == []


def test_cache_encodes_distinct_misses_only(spark, tmp_dir, monkeypatch):
    asked = []
    plain = token_counts.encode_counts
    monkeypatch.setattr(token_counts, "encode_counts", lambda texts, v: asked.append(sorted(r["text"] for r in texts.collect())) or plain(texts, v))
    first = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, None), (4, ""), (5, "a▁b")], "doc_id long, text string")
    more = spark.createDataFrame([(6, "a b"), (7, "c d e")], "doc_id long, text string")
    token_counts.count_tokens(first, tmp_dir)
    found = token_counts.count_tokens(more, tmp_dir)
    assert asked == [["", "a b"], ["c d e"]]
    assert {r["doc_id"]: r["n_tokens"] for r in found.collect()} == {6: 2, 7: 3}
    # another version of the tokenizer counts for itself
    monkeypatch.setattr(token_counts, "version", lambda v: "other")
    token_counts.count_tokens(more, tmp_dir)
    assert asked[2] == ["a b", "c d e"]


def test_counts_come_from_the_cache_and_equal_rows_count_once(spark, tmp_dir):
    import hashlib
    digest = hashlib.sha256(b"a b").digest()
    version = token_counts.version(token_counts.default_vocabulary())
    for _ in range(2):
        token_counts.append(spark.createDataFrame([(bytearray(digest), 77)], "digest binary, n_tokens long"), tmp_dir, version)
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "c")], "doc_id long, text string")
    assert sorted((r[0], r[2]) for r in token_counts.count_tokens(docs, tmp_dir).collect()) == [(1, 77), (1, 77), (2, 1)]

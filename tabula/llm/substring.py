"""Substring dedup: repeated fixed-length word windows, removed as maximal intervals.

Every window of ``width`` words gets a Rabin-Karp hash (64 bits).  Documents
go into chunks of consecutive ids, so that "starts in a document with a
smaller id" is either "in an earlier chunk" or settled inside the chunk.  A
chunk sends each distinct hash once, sorted and packed, to the bucket of its
leading bits; a bucket tells the chunks which of their hashes an earlier chunk
has too.  However often a window repeats, a bucket sees it once per chunk.
Chunks and buckets hold a bounded amount each and their number grows with the
input.  A chunk sends at most 2**FAN_BITS messages: with more buckets than
that, messages go through relays, each of which takes the messages of that
many chunks for one range of hashes and sends them on by finer ranges.  So the
messages grow with the input, not with chunks times buckets.

Two different windows have equal hashes with a chance of 2**-64 per pair:
about 1e-3 such pairs are expected for 2e8 windows.

Defined results: null and empty texts have no words; rows that share a
``doc_id`` are one document to each other (neither removes from the other);
rows without ``doc_id`` neither remove nor lose words; texts under ``width``
words keep them all; an empty table gives no rows; ids that are no numbers
raise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, chunked, mix64, powers, slices, word_spans

_WINDOW_BASE = 0xC2B2AE3D27D4EB4F
_WINDOW_INVERSE = pow(_WINDOW_BASE, -1, 1 << 64)

CHUNK_BYTES = 16 << 20
BUCKET_WINDOWS = 1 << 20
#: Messages of a chunk or relay, as a power of two.
FAN_BITS = 10


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of every window of ``width`` word hashes."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(words * powers(_WINDOW_BASE, len(words)), dtype=U64)])
        return mix64((sums[width:] - sums[:-width]) * powers(_WINDOW_INVERSE, n))


def _chunk_windows(text: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all windows of the documents in order, documents' first windows, documents' word counts)."""
    found, counts, n_words = [], [], []
    for part in slices(pa.record_batch([text], ["text"]), "text"):
        words = word_spans(part.column("text"))
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            own = window_hashes(words.hash[a:b], width)
            found.append(own)
            counts.append(len(own))
            n_words.append(b - a)
    return np.concatenate(found) if found else np.zeros(0, U64), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), np.array(n_words, np.int64)


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted 64-bit values as one width byte and their differences in that many bytes."""
    steps = np.diff(values, prepend=U64(0))
    size = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return bytes([size]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    size = blob[0]
    steps = np.zeros(((len(blob) - 1) // size, 8), np.uint8)
    steps[:, :size] = np.frombuffer(blob, np.uint8, offset=1).reshape(-1, size)
    return np.cumsum(steps.view("<u8").reshape(-1), dtype=U64)


def _ordered(rows: pa.Table) -> pa.Table:
    return rows.take(pc.sort_indices(rows, [("doc_id", "ascending")])).combine_chunks()


def _text(rows: pa.Table) -> pa.Array:
    whole = rows.column("text").combine_chunks()
    return whole.chunk(0) if isinstance(whole, pa.ChunkedArray) else whole


def exchange_levels(size: int, bucket_windows: int = BUCKET_WINDOWS, fan_bits: int = FAN_BITS) -> list[int]:
    """Bits of a hash that name its range after each exchange, for ``size`` bytes of text; the last are the buckets."""
    bits = (max(1, -(-size // (6 * bucket_windows))) - 1).bit_length()
    return [min(bits, k * fan_bits) for k in range(1, max(1, -(-bits // fan_bits)) + 1)]


def _messages(hashes: np.ndarray, chunks: np.ndarray, bits: int, group: int) -> pa.Table:
    """One row for every range of ``bits`` that sorted ``hashes`` fall into; ``chunks`` is one number or one a hash."""
    ranges = (hashes >> U64(64 - bits)) if bits else np.zeros(len(hashes), U64)
    starts = np.concatenate([[0], np.flatnonzero(ranges[1:] != ranges[:-1]) + 1]).astype(np.int64)[: len(hashes)]
    ends = np.append(starts[1:], len(hashes)).astype(np.int64)[: len(starts)]
    of = [chunks[a:b] if len(chunks) > 1 else chunks for a, b in zip(starts, ends, strict=True)]
    return pa.table({"bucket": pa.array(ranges[starts].astype(np.int64)), "grp": pa.array(np.full(len(starts), group)),
                     "chunks": pa.array([x.astype("<u4").tobytes() for x in of], pa.binary()),
                     "hashes": pa.array([pack_sorted(hashes[a:b]) for a, b in zip(starts, ends, strict=True)], pa.binary())})


def _received(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Hashes in order and the chunk of each; of equal hashes the earliest chunk's first."""
    parts = [unpack_sorted(x) for x in rows.column("hashes").to_pylist()]
    chunks = [np.frombuffer(x, "<u4") for x in rows.column("chunks").to_pylist()]
    chunks = np.concatenate([np.broadcast_to(c, len(p)) if len(c) == 1 else c for c, p in zip(chunks, parts, strict=True)])
    hashes = np.concatenate(parts)
    order = np.lexsort((chunks, hashes))
    return hashes[order], chunks[order].astype(np.int64)


def remove_repeats(docs: DataFrame, width: int = 50, chunk_bytes: int = CHUNK_BYTES, bucket_windows: int = BUCKET_WINDOWS, fan_bits: int = FAN_BITS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every row: words that no repeated window covers."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    placed, size = chunked(docs, chunk_bytes)
    levels = exchange_levels(size, bucket_windows, fan_bits)

    def send(rows: pa.Table) -> pa.Table:
        chunk = rows.column("chunk")[0].as_py()
        known = chunk >= 0 and rows.num_rows
        hashes = np.unique(_chunk_windows(_text(rows), width)[0]) if known else np.zeros(0, U64)
        return _messages(hashes, np.array([max(chunk, 0)]), levels[0], max(chunk, 0) >> fan_bits)

    def relay(bits: int):
        def run(rows: pa.Table) -> pa.Table:
            hashes, chunks = _received(rows)
            return _messages(hashes, chunks, bits, rows.column("grp")[0].as_py() >> fan_bits)

        return run

    def answer(rows: pa.Table) -> pa.Table:
        hashes, chunks = _received(rows)
        again = np.flatnonzero(hashes[1:] == hashes[:-1]) + 1
        order = again[np.lexsort((hashes[again], chunks[again]))]
        owner = chunks[order]
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        parts = np.split(hashes[order], starts[1:]) if len(starts) else []
        return pa.table({"chunk": pa.array(owner[starts]), "hashes": pa.array([pack_sorted(x) for x in parts], pa.binary())})

    def apply(docs_: pa.Table, replies: pa.Table) -> pa.Table:
        docs_ = _ordered(docs_)
        blobs = [unpack_sorted(x) for x in replies.column("hashes").to_pylist()]
        earlier = np.sort(np.concatenate(blobs)) if blobs else np.zeros(0, U64)
        text, ids = _text(docs_), docs_.column("doc_id").to_pylist()
        hashes, first, n_words = _chunk_windows(text, width)
        hit = np.zeros(len(hashes), bool)
        if len(earlier):
            at = np.minimum(np.searchsorted(earlier, hashes), len(earlier) - 1)
            hit = earlier[at] == hashes
        # inside the chunk: equal to a window of a smaller id
        rank = np.repeat(np.unique([-1 if x is None else x for x in ids], return_inverse=True)[1], np.diff(first)) if ids else np.zeros(0, np.int64)
        named = np.repeat(np.array([x is not None for x in ids], bool), np.diff(first))
        hit &= named
        order = np.lexsort((rank, hashes))
        order = order[named[order]]
        if len(order):
            new = np.concatenate([[True], hashes[order[1:]] != hashes[order[:-1]]])
            smallest = rank[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
            hit[order] |= rank[order] > smallest
        out_removed, out_text = [], []
        for row, (a, b, n) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), n_words.tolist(), strict=True)):
            own = hit[a:b]
            words = (text[row].as_py() or "").encode().split()
            if own.any():
                # windows that follow each other merge into maximal intervals
                edge = np.zeros(n + 1, np.int64)
                starts = np.flatnonzero(own)
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + width, -1)
                keep = np.cumsum(edge[:-1]) == 0
                words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
            out_removed.append(n - len(words))
            out_text.append(b" ".join(words))
        return pa.table({"doc_id": docs_.column("doc_id").combine_chunks(), "n_words": pa.array(n_words), "n_removed": pa.array(out_removed, pa.int64()), "kept_text": pa.array(out_text, pa.binary())})

    message = "bucket long, grp long, chunks binary, hashes binary"
    sent = placed.groupBy("chunk").applyInArrow(send, message)
    for bits in levels[1:]:
        sent = sent.groupBy("bucket", "grp").applyInArrow(relay(bits), message)
    replies = sent.groupBy("bucket").applyInArrow(answer, "chunk long, hashes binary")
    return placed.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(apply, f"doc_id {kind}, n_words long, n_removed long, kept_text binary")


def report(docs: DataFrame, width: int = 50) -> DataFrame:
    """The query's columns: counts and the digest of the kept words."""
    kept = remove_repeats(docs, width)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))

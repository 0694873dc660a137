"""Resampling documents towards a target distribution, by hashed n-gram features.

Features are the runs of one to ``n`` consecutive words; a feature's bucket is
its CRC-32 modulo ``BUCKETS``.  The gain of a bucket says, in thousandths of a
nat, how much likelier the target's texts are to show it than the corpus.  A
document's weight is the floored mean gain of its features; the draw takes the
highest sums of weight and Gumbel noise, which is sampling without replacement
in proportion to exp(weight / 1000).

Weights come from bit slices.  The bucket counts of a document are written as
bit planes of ``BUCKETS`` bits (plane i has bit i of every count), the gains
as two's-complement planes (the top one counts negative).  A plane of counts
AND a plane of gains, its ones counted and scaled by the product of both
powers of two, is an exact part of the sum; no product or rounding occurs.

Corpus and target counts cover all documents: a task sums its vector of
buckets, Spark adds them, and the driver gets ``BUCKETS`` numbers.  Ranks need
no single task: the score histogram (scores are whole thousandths, so it has
at most some 10^5 entries whatever the corpus) gives the cut, the drawn rows
are range-partitioned, and a place is that of the row within its part plus
the parts before.

Defined results: null and empty texts have no feature, weight 0 and are never
drawn if words are asked for; null ids hash as the empty text and rank last
among ties; repeated rows are rows of their own; an empty corpus gives no
rows, an empty target makes every gain a function of the corpus alone.  Extra
columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, write_scratch

BUCKETS = 10_000
#: Documents whose counts are held as planes at once.
_ROWS = 256
#: Features a worker keeps buckets of.
_CACHED = 2_000_000

# ASCII: digits and letters stay (letters in lower case), all else parts words; bytes from 0x80 on belong to words
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


class _Buckets(dict):
    """Feature (UTF-8) -> bucket."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        self[feature] = found = zlib.crc32(feature) % self.buckets
        return found


_KNOWN: dict[int, _Buckets] = {}


def _known(buckets: int) -> _Buckets:
    found = _KNOWN.setdefault(buckets, _Buckets(buckets))
    if len(found) > _CACHED:
        found.clear()
    return found


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def features_of(words: list[bytes], n: int) -> list[bytes]:
    """All runs of 1 to ``n`` consecutive words, joined by one space."""
    if n == 1:
        return words
    return [b" ".join(words[i:i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def _hashed(part: pa.RecordBatch, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and features of every row, and the buckets of all features end to end."""
    known = _known(buckets)
    words = [words_of(t) if t else [] for t in part.column("text").cast(pa.large_binary()).to_pylist()]
    features = words if n == 1 else [features_of(w, n) for w in words]
    sizes = np.fromiter(map(len, features), np.int64, len(features))
    found = np.fromiter(map(known.__getitem__, chain.from_iterable(features)), np.int64, int(sizes.sum()))
    return np.fromiter(map(len, words), np.int64, len(words)), sizes, found


def bucket_totals(docs: DataFrame, n: int = 1, buckets: int = BUCKETS, text_col: str = "text") -> np.ndarray:
    """Features of all documents by bucket: one vector a task, added up by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                total += np.bincount(_hashed(part, n, buckets)[2], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["bucket", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, found in counted.groupBy("bucket").agg(F.sum("n")).collect():  # BUCKETS rows at most
        out[bucket] = found
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log ratio of add-one smoothed shares, in doubles."""
    s, t, b = corpus.astype(float), target.astype(float), float(len(corpus))
    ratio = (t + 1) * (s.sum() + b) / ((s + 1) * (t.sum() + b))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    wide = -(-bits.shape[-1] // 64) * 8
    out = np.zeros((*bits.shape[:-1], wide), np.uint8)
    found = np.packbits(bits, axis=-1)
    out[..., : found.shape[-1]] = found
    return out.view(np.uint64)


def gain_planes(gain: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(scale, plane) for every two's-complement bit of the gains; the top bit's scale is negative."""
    top = max(int(gain.max(initial=0)), -int(gain.min(initial=0)) - 1).bit_length()
    return [(-(1 << i) if i == top else 1 << i, _packed((gain >> i & 1).astype(bool))) for i in range(top + 1)]


def weigh(rows: np.ndarray, found: np.ndarray, n_rows: int, planes: list[tuple[int, np.ndarray]], buckets: int) -> np.ndarray:
    """Sum of the gains of every row's features: ``rows`` and ``found`` name the row and bucket of each feature."""
    count = np.bincount(rows * buckets + found, minlength=n_rows * buckets).reshape(n_rows, buckets)
    most = int(count.max(initial=0))
    count = count.astype(np.min_scalar_type(most))
    out = np.zeros(n_rows, np.int64)
    for i in range(most.bit_length()):
        plane = _packed((count >> i & 1).astype(bool))
        for scale, gain in planes:
            out += (scale << i) * np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64)
    return out


def weights(docs: DataFrame, gain: np.ndarray, n: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    planes, buckets = gain_planes(gain), len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words, sizes, found = _hashed(part, n, buckets)
                ends, total = np.cumsum(sizes), np.zeros(len(sizes), np.int64)
                for a in range(0, len(sizes), _ROWS):
                    some = sizes[a: a + _ROWS]
                    of = found[ends[a] - sizes[a]: ends[a + len(some) - 1]]
                    total[a: a + _ROWS] = weigh(np.repeat(np.arange(len(some)), some), of, len(some), planes, buckets)
                mean = np.where(sizes > 0, total // np.maximum(sizes, 1), 0)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, (words, sizes, mean))], ["doc_id", "n_words", "n_features", "weight"])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(id_col: str, seed: int):
    """Floored thousandths of Gumbel noise from the SHA-256 of ``<seed>:<id>``."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(scored: DataFrame, allowed, percent: int) -> DataFrame:
    """Add ``rank``: 1, 2, 3 ... for the ``percent`` of the allowed rows with the highest scores, null for others."""
    scored = write_scratch(scored.withColumn("_in", allowed), "importance-scores")
    histogram = sorted(scored.filter("_in").groupBy("score").count().collect(), reverse=True)  # bounded: scores are whole thousandths
    wanted = sum(n for _, n in histogram) * percent // 100
    above, cut = 0, None
    for score, n in histogram:
        if above >= wanted:
            break
        above, cut = above + n, score
    near = F.col("_in") & (F.col("score") >= F.lit(cut)) if cut is not None else F.lit(False)
    # equal rows are parted by their places in the written table, so no part can grow with them
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    top = scored.filter(near).withColumn("_row", F.monotonically_increasing_id())
    placed = top.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = write_scratch(placed.withColumn("_part", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "importance-drawn")
    # one row a part
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.col("_place") + F.col("_before") + 1
    drawn = placed.join(parts.select("_part", before.alias("_before")), "_part").withColumn("rank", F.when(place <= wanted, place))
    columns = [c for c in scored.columns if c != "_in"]
    rest = scored.filter(~F.coalesce(near, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return drawn.select(*columns, "rank").unionAll(rest.select(*columns, "rank"))


def resample(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = BUCKETS, least_words: int = 20,
             percent: int = 10, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; undrawn ones have a null rank."""
    gain = gains(bucket_totals(docs, n, buckets, text_col), bucket_totals(target, n, buckets, text_col))
    found = weights(docs, gain, n, id_col, text_col)
    scored = found.withColumn("score", F.col("weight") + noise("doc_id", seed))
    return ranked(scored, F.col("n_words") >= least_words, percent).select("doc_id", "n_features", "weight", "score", "rank")

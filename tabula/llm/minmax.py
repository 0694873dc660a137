"""Near-duplicate documents by min-max hashing, with exact confirmation.

Every permutation of the shingles gives two signature values, its minimum and
its maximum, so hash evaluations halve for the same signature.  Bands of
signature values propose candidates; a document pair at the threshold shares
none of its bands with a chance of about 2e-9 (the sketch comparison below
misses one with another 1e-11).

* Documents with equal shingle sets collapse to one representative first, so
  a group of copies costs one row from then on.
* A document with too many shingles that no other candidate has can't reach
  the similarity with any, and leaves the search.
* A band's bucket never emits its pairs.  In the first round each document is
  confirmed against one hub alone, the member of its buckets that has fewest
  such shingles, which is the centre of a group of edited copies; the links
  make components.
* Whatever buckets then hold of different components is compared completely
  (sizes, shared shingles and signature sketches first, shingle sets for the
  rest), so that no link between components is lost.

Defined results: null and empty texts have no shingles and link with nothing;
a text of fewer words than a shingle has its whole sequence as one; rows that
share a ``doc_id`` count as one document, which has the links of all of them;
rows without ``doc_id`` link with nothing, have no component and are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, mix64, powers, slices, within, word_spans, write_scratch
from .components import components

PERMUTATIONS = 128
VALUES = 2 * PERMUTATIONS
_SHINGLE_BASE = 0xD6E8FEB86659FD93


def band_rows(percent: int, miss: float = 1e-8) -> int:
    """Most rows a band can have while a pair at the threshold is missed with a chance below ``miss``."""
    chance = percent / 100
    fitting = [r for r in range(1, 33) if (1 - chance ** r) ** (VALUES // r) <= miss]
    return max(fitting, default=1)


def _shingles(words, n: int) -> Iterator[np.ndarray]:
    """Distinct shingle hashes of each document, sorted."""
    with np.errstate(over="ignore"):
        factors = powers(_SHINGLE_BASE, n)
        count = len(words.hash)
        whole = np.zeros(max(count - n + 1, 0), U64)
        for j in range(n):
            whole += words.hash[j: j + len(whole)] * factors[j]
        whole = mix64(whole)
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            if b - a >= n:
                yield np.unique(whole[a: b - n + 1])
            elif b > a:
                yield mix64(np.sum(words.hash[a:b] * factors[: b - a], dtype=U64, keepdims=True) + U64(b - a))
            else:
                yield whole[:0]


def _signature(shingles: np.ndarray, masks: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Minima, then maxima, of the shingles under every permutation."""
    low = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    high = np.zeros(PERMUTATIONS, np.uint32)
    short = (shingles >> U64(32)).astype(np.uint32)
    for at in range(0, len(short), 2048):
        x = short[at: at + 2048, None] ^ masks
        x *= factors
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        np.minimum(low, x.min(0), out=low)
        np.maximum(high, x.max(0), out=high)
    return np.concatenate([low, high])


def _lists(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as a list column."""
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values.reshape(-1).view(np.int64)))


def signatures(docs: DataFrame, n: int, percent: int, seed: int = 42) -> DataFrame:
    """(doc_id, n_shingles, f1, f2, bands, sketch) of every whole text.

    ``f1, f2`` identify the shingle set (128 bits); ``bands`` are bucket keys;
    ``sketch`` has one bit of each signature value.
    """
    rows = band_rows(percent)
    bands = VALUES // rows
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(seed)
        masks, factors = rng.integers(0, 1 << 32, (2, PERMUTATIONS), np.uint32)
        factors |= np.uint32(1)
        salt = mix64(np.arange(1, bands + 1, dtype=U64))
        mixers = powers(_SHINGLE_BASE, rows)
        for batch in batches:
            for part in slices(batch, "text"):
                words = word_spans(part.column("text"), lower=True)
                size = np.zeros(part.num_rows, np.int64)
                prints = np.zeros((part.num_rows, 2), U64)
                values = np.zeros((part.num_rows, VALUES), np.uint32)
                with np.errstate(over="ignore"):
                    for row, own in enumerate(_shingles(words, n)):
                        if len(own):
                            size[row] = len(own)
                            prints[row] = mix64(own).sum(dtype=U64), mix64(own ^ U64(0xA5A5A5A55A5A5A5A)).sum(dtype=U64)
                            values[row] = _signature(own, masks, factors)
                    banded = values[:, : bands * rows].reshape(-1, bands, rows).astype(U64) + U64(1)
                    keys = mix64((banded * mixers).sum(2, dtype=U64) + salt)
                    bits = np.packbits((values * np.uint32(0x9E3779B1) >> np.uint32(31)).astype(bool), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size), pa.array(prints[:, 0].copy().view(np.int64)), pa.array(prints[:, 1].copy().view(np.int64)),
                     _lists(keys), _lists(np.ascontiguousarray(bits).view(U64))],
                    ["doc_id", "n_shingles", "f1", "f2", "bands", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(sign, f"doc_id {kind}, n_shingles long, f1 long, f2 long, bands array<long>, sketch array<long>")


def shingle_sets(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, shingles): the full sets."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                sets = list(_shingles(word_spans(part.column("text"), lower=True), n))
                ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
                values = np.concatenate(sets) if sets else np.zeros(0, U64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))], ["doc_id", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(collect, f"doc_id {kind}, shingles array<long>")


def _alike(percent: int) -> float:
    """Least number of equal sketch bits of a pair at the threshold, eight deviations below the mean."""
    p = (1 + percent / 100) / 2
    return VALUES * p - 8 * math.sqrt(VALUES * p * (1 - p))


def _hopeful(x: Column, y: Column, percent: int) -> Column:
    """Sizes and shared shingles allow the similarity, and the sketches don't rule it out."""
    words = VALUES // 64
    apart = sum((F.bit_count(x["sketch"][i].bitwiseXOR(y["sketch"][i])) for i in range(1, words)), F.bit_count(x["sketch"][0].bitwiseXOR(y["sketch"][0])))
    sizes = F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * percent
    shared = F.least(x["n"] - x["own"], y["n"] - y["own"]) * (100 + percent) >= (x["n"] + y["n"]) * percent
    return sizes & shared & (F.lit(VALUES) - apart >= F.lit(_alike(percent)))


def _facts(reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(doc_id, x) of the members that can have a link: size, sketch, and how many shingles are theirs alone.

    A shingle that no other member has is in no intersection; a document with
    too many of them has no partner at all, however alike the rest of it is.
    """
    single = sets.select("doc_id", F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id")).filter("n = 1")
    own = single.groupBy("doc_id").agg(F.count(F.lit(1)).alias("own"))
    known = sets.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    # an id with several sets: its own shingles can't be told apart
    own = known.join(own, "doc_id", "left").select("doc_id", F.when(F.col("rows") > 1, 0).otherwise(F.coalesce("own", F.lit(0))).alias("own"))
    facts = reps.select("doc_id", "n", "sketch").join(own, "doc_id").filter((F.col("n") - F.col("own")) * 100 >= F.col("n") * percent)
    return facts.select("doc_id", F.struct("own", "n", "sketch").alias("x"))


def _same_hub(x: Column, y: Column, percent: int) -> Column:
    """What the distances to a common hub leave possible.

    With d the size of a set's difference from the hub, two sets differ by
    d_x + d_y - 2 * (what the differences share), and they share at most what
    is not a document's own.
    """
    shared = F.least(x["far"] - x["own"], y["far"] - y["own"])
    able = (shared * 2 - x["far"] - y["far"]) * (100 + percent) + (x["n"] + y["n"]) * (100 - percent) >= 0
    return (x["hub"] != y["hub"]) | able


def _shared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with the sizes of their full sets and of the intersection."""
    one = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    other = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    both = pairs.join(one, "b").join(other, "a")
    return both.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("both"))


def _linked(percent: int) -> Column:
    return F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    ``n``: words of a shingle; ``percent``: least Jaccard similarity of a link.
    """
    signed = write_scratch(signatures(docs, n, percent), "minmax-signed")
    linkable = signed.filter("n_shingles > 0 and doc_id is not null")
    reps = linkable.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", F.col("n_shingles").alias("n"), "sketch", "bands")).alias("r")).select("f1", "f2", "r.*")
    reps = write_scratch(reps, "minmax-reps")
    # bands are the widest table of keys: they are dealt by key once, buckets of one document leave there
    by_key = Window.partitionBy("key")
    buckets = reps.select(F.explode("bands").alias("key"), "doc_id")
    full = buckets.withColumns({"low": F.min("doc_id").over(by_key), "top": F.max("doc_id").over(by_key)}).filter("low <> top")
    shared = write_scratch(full.select("key", "doc_id"), "minmax-buckets")
    sets = write_scratch(shingle_sets(within(docs.select("doc_id", "text"), shared, "doc_id"), n), "minmax-sets")
    facts = write_scratch(_facts(reps, sets, percent), "minmax-facts")

    # first round: each document against the hub of its buckets that has least of its own
    able = shared.join(facts.select("doc_id", F.struct("x.own", "doc_id").alias("h")), "doc_id")
    hubs = able.groupBy("key").agg(F.min("h").alias("hub"))
    first = able.join(hubs, "key").groupBy("doc_id").agg(F.min("hub").alias("hub")).select(F.col("doc_id").alias("b"), F.col("hub.doc_id").alias("a"))
    near = write_scratch(_shared(first.filter("a <> b"), sets), "minmax-near")
    links = near.filter(_linked(percent)).select("a", "b")
    found = components(links)

    # second round: what buckets hold of different components
    label = F.coalesce("component", "doc_id")
    placed = able.select("key", "doc_id").join(found, F.col("doc_id") == F.col("node"), "left").select("key", "doc_id", label.alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("key")
    # an id with several sets has several distances; the pair of hub and distance must come from one row of it
    far = near.select(F.col("b").alias("doc_id"), F.col("a").alias("hub"), (F.col("na") + F.col("nb") - 2 * F.col("both")).alias("far"))
    far = far.unionAll(first.filter("a = b").select(F.col("b").alias("doc_id"), F.col("a").alias("hub"), F.lit(0).alias("far")))
    far = far.groupBy("doc_id").agg(F.min("hub").alias("hub"), F.max("far").alias("far"), F.count(F.lit(1)).alias("rows"))
    hub, away = F.when(F.col("rows") == 1, F.col("hub")), F.when(F.col("rows") == 1, F.col("far"))
    placing = facts.join(reps.select("doc_id", "bands"), "doc_id").join(far, "doc_id", "left").select("doc_id", F.struct("x.*", "bands", hub.alias("hub"), away.alias("far")).alias("x"))
    rest = write_scratch(placed.join(mixed, "key", "left_semi").join(placing, "doc_id").select("key", "doc_id", "component", "x"), "minmax-mixed")
    left, right = rest.alias("l"), rest.alias("r")
    cross = (left.join(right, (F.col("l.key") == F.col("r.key")) & (F.col("l.component") < F.col("r.component"))
                       & _hopeful(F.col("l.x"), F.col("r.x"), percent) & F.coalesce(_same_hub(F.col("l.x"), F.col("r.x"), percent), F.lit(True))
                       # a pair comes out of the first bucket it shares only
                       & (F.get(F.array_intersect("l.x.bands", "r.x.bands"), F.lit(0)) == F.col("l.key")))
             .select(F.col("l.doc_id").alias("a"), F.col("r.doc_id").alias("b")).distinct())
    # few documents are left to compare: only their sets move
    cross = write_scratch(cross, "minmax-cross")
    asked = sets.join(cross.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "doc_id", "left_semi")
    more = write_scratch(_shared(cross, asked).filter(_linked(percent)).select("a", "b"), "minmax-more")
    found = components(links.unionAll(more)) if more.take(1) else found

    classes = reps.select("f1", "f2", F.col("doc_id").alias("node_")).join(found, F.col("node_") == F.col("node"), "left").select("f1", "f2", F.coalesce("component", "node_").alias("component"))
    whole = signed.select("doc_id", "n_shingles", "f1", "f2").join(classes, ["f1", "f2"], "left")
    linked = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component"))
    out = whole.select("doc_id", "n_shingles", F.coalesce(linked, F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


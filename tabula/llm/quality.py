"""Quality classifier: random-indexing word vectors, pooled, into a two-layer network.

Words are cut into runs of letters, digits and marks; a run's *unit* is its
whole spelling, hashed into a fixed number of places.  Random indexing gives
every unit a sparse random index vector and sums, over all documents, the
index vectors of its neighbours: its word vector, which needs no labels.  A
text's features are its mean word vector and the mean product of neighbouring
ones; a two-layer numpy network turns them into a logit, which a temperature
fitted on rows kept from training makes a calibrated chance.

The network is fitted on about ``max_docs`` labelled rows, drawn by hash of
their id.  Every document is scored over its whole text.

Defined results: null and empty texts have zero features, and the score that
the network gives those; equal texts get equal scores; labelled rows without
a document or a label teach nothing, repeated ones once (the higher label);
without training rows of both labels the score is their mean (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField, StructType

from .common import U64, drawn, mix64, powers, slices, text_bytes, write_scratch

UNIT_BITS = 16
UNITS = 1 << UNIT_BITS
WIDTH = 32
NONZERO = 4
WINDOW = 2
MAX_DOCS = 6000
HIDDEN = 32
EPOCHS = 200
_BLOCK = 256
_BASE = 0x9E3779B97F4A7C15
_TRAIN_TASKS = 8

_KIND = np.zeros(256, np.uint8)  # 0 blank, 1 letter, 2 digit, 3 mark
_KIND[33:127] = 3
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2
_KIND[[*range(0, 9), *range(14, 32), 127]] = 3


def units(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(unit of every run, each text's first run)."""
    data, docs = text_bytes(text)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(docs), np.int64)
    kind = _KIND[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[docs] = True
    at = np.flatnonzero(edge)
    start, end = at[:-1], at[1:]
    real = kind[start] > 0
    start, end = start[real], end[real]
    place = np.arange(len(data)) - np.repeat(at[:-1], np.diff(at))
    with np.errstate(over="ignore"):
        key = np.add.reduceat((data.astype(U64) + U64(1)) * powers(_BASE, int(place.max()) + 1)[place], at[:-1])[real]
    return (mix64(key) >> U64(64 - UNIT_BITS)).astype(np.int64), np.searchsorted(start, docs)


def _index_vectors(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of every unit's index vector."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, WIDTH, (UNITS, NONZERO)), rng.choice([-1.0, 1.0], (UNITS, NONZERO))


def word_vectors(texts: DataFrame, seed: int = 42) -> np.ndarray:
    """(UNITS, WIDTH) unit-length vectors; the table has a fixed size whatever the texts."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = _index_vectors(seed)
        total = np.zeros(UNITS * WIDTH, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                found, first = units(part.column("text"))
                owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
                for apart in range(1, WINDOW + 1):
                    same = owner[apart:] == owner[:-apart]
                    one, other = found[:-apart][same], found[apart:][same]
                    for word, near in ((one, other), (other, one)):
                        at = (word * WIDTH)[:, None] + places[near]
                        total += np.bincount(at.ravel(), signs[near].ravel(), UNITS * WIDTH).astype(np.int64)
        blocks = total.reshape(UNITS // _BLOCK, _BLOCK, WIDTH)
        for b in np.flatnonzero(blocks.any((1, 2))):  # only the units that this task has
            used = np.flatnonzero(blocks[b].any(1))
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([used.astype(np.int32).tobytes()], pa.binary()), pa.array([blocks[b][used].astype(np.int32).tobytes()], pa.binary())], ["block", "used", "sums"])

    def add(rows: pa.Table) -> pa.Table:
        whole = np.zeros((_BLOCK, WIDTH))
        for used, sums in zip(rows.column("used"), rows.column("sums"), strict=True):
            whole[np.frombuffer(used.as_py(), np.int32)] += np.frombuffer(sums.as_py(), np.int32).reshape(-1, WIDTH)
        return pa.table({"block": rows.column("block").combine_chunks()[:1], "sums": pa.array([whole.tobytes()], pa.binary())})

    summed = texts.select("text").mapInArrow(index, "block int, used binary, sums binary").groupBy("block").applyInArrow(add, "block int, sums binary")
    out = np.zeros((UNITS // _BLOCK, _BLOCK * WIDTH))
    for row in summed.collect():
        out[row["block"]] = np.frombuffer(row["sums"])
    out = out.reshape(UNITS, WIDTH)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(text: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """(texts, 2 * WIDTH): mean vector, and mean product of neighbours."""
    found, first = units(text)
    count = np.diff(first)
    out = np.zeros((len(count), 2 * WIDTH))
    some = np.flatnonzero(count)
    if len(some):
        own = vectors[found]
        out[some, :WIDTH] = np.add.reduceat(own, first[some], dtype=np.float64)
        product = np.zeros_like(own)
        np.multiply(own[1:], own[:-1], out=product[1:])
        product[first[some]] = 0
        out[some, WIDTH:] = np.add.reduceat(product, first[some], dtype=np.float64)
        out[some] /= count[some, None]
    return out


class Network(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -500, 500)))


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 42) -> Network:
    """Adam on the log loss; a fifth of the rows fits the temperature instead."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    aside, order = order[: len(x) // 5], order[len(x) // 5:]
    mean, scale = x[order].mean(0), x[order].std(0) + 1e-6
    z = (x - mean) / scale
    params = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        rng.shuffle(order)
        for at in range(0, len(order), 128):
            rows = order[at: at + 128]
            hidden = np.tanh(z[rows] @ params[0] + params[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -30, 30))) - y[rows]) / len(rows)
            back = np.outer(error, params[2]) * (1 - hidden ** 2)
            step += 1
            for k, grad in enumerate((z[rows].T @ back + 1e-4 * params[0], back.sum(0), hidden.T @ error + 1e-4 * params[2], error.sum(keepdims=True))):
                first[k] += 0.1 * (grad - first[k])
                second[k] += 0.001 * (grad ** 2 - second[k])
                params[k] -= 0.003 * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    raw = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]), 1.0)
    if not len(aside):
        return raw
    logits, truth = raw.logit(x[aside]), y[aside]
    losses = {t: float(np.mean(np.logaddexp(0, np.where(truth == 1, -logits, logits) / t))) for t in np.geomspace(0.25, 16, 61)}
    return raw._replace(temperature=float(min(losses, key=losses.get)))


class Model(NamedTuple):
    vectors: np.ndarray
    network: Network | None
    constant: float


def _features(rows: DataFrame, vectors: np.ndarray, carry: list[str]) -> DataFrame:
    schema = StructType([*(rows.schema[c] for c in carry), StructField("x", ArrayType(FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x = pooled(part.column("text"), vectors).astype(np.float32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carry), lists], schema.names)

    return rows.select(*carry, "text").mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> Model:
    """Fit on documents (doc_id, text) and labels (doc_id, quality)."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = drawn(known, max_docs, "doc_id")
    # about max_docs rows of two numbers: the draw bounds the size
    sample = write_scratch(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text").repartition(_TRAIN_TASKS, "doc_id"), "quality-sample")
    vectors = word_vectors(docs)
    rows = _features(sample, vectors, ["doc_id", "quality"]).orderBy("doc_id").collect()
    y = np.array([float(r["quality"]) for r in rows])
    if not len(y) or y.min() == y.max():
        return Model(vectors, None, float(y.mean()) if len(y) else 0.5)
    return Model(vectors, fit_network(np.array([r["x"] for r in rows], float), y), 0.5)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score): chance that a row's quality is 1."""
    schema = StructType([docs.schema["doc_id"], StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                if model.network is None:
                    found = np.full(part.num_rows, model.constant)
                else:
                    found = model.network.chance(pooled(part.column("text"), model.vectors))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)

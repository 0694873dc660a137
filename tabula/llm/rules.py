"""Quality rules: statistics of every text, judged by an isolation forest.

Rule statistics come from one pass over the whole text.  An isolation forest
scores them: random splits cut anomalous rows off after few steps, so a short
mean path means an anomaly.  The trees are grown on a bounded sample of rows;
the score above which a document fails is calibrated on labelled rows, by a
histogram that covers all of them.

Defined results: null and empty texts have zero statistics and fail the base
rules, as every text under ``MIN_WORDS`` words does; equal texts get equal
verdicts; without labelled rows of both kinds only the base rules decide; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .common import drawn, slices, word_spans, write_scratch
from .substring import window_hashes

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WIDTH = 8
TREES = 100
TREE_ROWS = 256
#: Bounds of the sample that grows the trees.
SAMPLE_ROWS = 4096
#: Share of the labelled good rows that the threshold may fail.
MAX_GOOD_LOSS = 0.004
BINS = 1000
#: Ordinary words added to each text before rates are taken, which steadies those of short texts.
EVEN = 30

#: Fixed value: the characters that count as symbols.
SYMBOLS = b"[#*$%&|<>]"[1:-1]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_upper", "n_shouts", "n_echoes"]


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL = _table(SYMBOLS)
_UPPER = _table(bytes(range(65, 91)))
_SHOUT = _table(b"!?")
_CHAR = np.array([(b & 0xC0) != 0x80 for b in range(256)])


def _repeat_words(hashes: np.ndarray, width: int = REPEAT_WIDTH) -> int:
    """Words in windows that occur twice or more among the document's windows."""
    windows = window_hashes(hashes, width)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    edge = np.zeros(len(hashes) + 1, np.int64)
    repeated = np.zeros(len(windows), bool)
    repeated[order[1:][same]] = repeated[order[:-1][same]] = True
    edge[: len(windows)] += repeated
    edge[width: width + len(windows)] -= repeated
    return int((np.cumsum(edge[:-1]) > 0).sum())


def _dup_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def _echoes(words) -> np.ndarray:
    """Words of each document that equal the word before."""
    same = np.concatenate([[False], words.hash[1:] == words.hash[:-1]]) if len(words.hash) else np.zeros(0, bool)
    same[words.first[:-1][words.first[:-1] < len(same)]] = False
    return np.diff(np.concatenate([[0], np.cumsum(same, dtype=np.int64)])[words.first])


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every row's whole text, long."""
    kind = docs.schema["doc_id"]
    schema = StructType([kind, *(StructField(c, LongType()) for c in COUNTS + MORE)])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = word_spans(part.column("text"))
                data, docs_ = words.data, words.docs

                def per_doc(mask: np.ndarray) -> np.ndarray:
                    return np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[docs_])

                inside = np.zeros(len(data) + 1, np.int8)
                inside[words.start] += 1
                inside[words.end] -= 1  # a word's end may be the next document's first byte
                in_word = np.cumsum(inside[:-1], dtype=np.int8) > 0
                raw = data.tobytes()
                bounds = list(zip(docs_[:-1].tolist(), docs_[1:].tolist(), strict=True))
                spans = zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)
                counts = [np.diff(words.first), per_doc(in_word & _CHAR[data]), per_doc(_SYMBOL[data]),
                          np.array([_dup_lines(raw[a:b]) for a, b in bounds], np.int64),
                          np.array([_repeat_words(words.hash[a:b]) for a, b in spans], np.int64),
                          per_doc(_UPPER[data]), per_doc(_SHOUT[data]), _echoes(words)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c.astype(np.int64)) for c in counts)], schema.names)

    return docs.select("doc_id", "text").mapInArrow(measure, schema)


def features(counts: np.ndarray) -> np.ndarray:
    """Rates that the forest splits on, from columns in the order COUNTS + MORE.

    Repetition has a base rule; good texts that quote a passage twice would
    only look anomalous, so the forest doesn't see it again.
    """
    words, chars, symbols, _, _, upper, shouts, echoes = counts.astype(float).T
    return np.column_stack([(chars + 5 * EVEN) / (words + EVEN), symbols / (words + EVEN), upper / (chars + 5 * EVEN), shouts / (words + EVEN), echoes / (words + EVEN)])


class Forest(NamedTuple):
    """Trees as arrays: split column (-1: leaf), split value, left child (the right one follows), and path length at a leaf."""

    column: np.ndarray
    value: np.ndarray
    left: np.ndarray
    path: np.ndarray
    norm: float


def _expected_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


def grow(rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 42) -> Forest:
    rng = np.random.default_rng(seed)
    size = min(tree_rows, len(rows))
    deepest = int(np.ceil(np.log2(max(size, 2))))
    nodes = 2 ** (deepest + 2)
    column, left = np.full((trees, nodes), -1, np.int32), np.zeros((trees, nodes), np.int32)
    value, path = np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for t in range(trees):
        todo, used = [(0, rows[rng.choice(len(rows), size, replace=False)], 0)], 1
        while todo:
            node, own, depth = todo.pop()
            wide = np.flatnonzero(own.max(0) > own.min(0)) if len(own) > 1 and depth < deepest else []
            if not len(wide):
                path[t, node] = depth + _expected_path(len(own))
                continue
            c = int(rng.choice(wide))
            cut = rng.uniform(own[:, c].min(), own[:, c].max())
            column[t, node], value[t, node], left[t, node] = c, cut, used
            below = own[:, c] <= cut
            todo += [(used, own[below], depth + 1), (used + 1, own[~below], depth + 1)]
            used += 2
    return Forest(column, value, left, path, max(_expected_path(size), 1e-9))


def anomaly(forest: Forest, rows: np.ndarray) -> np.ndarray:
    """Score in (0, 1): 2 ** -(mean path / expected path)."""
    total = np.zeros(len(rows))
    for column, value, left, path in zip(forest.column, forest.value, forest.left, forest.path, strict=True):
        node = np.zeros(len(rows), np.int32)
        while True:
            c = column[node]
            inner = np.flatnonzero(c >= 0)
            if not len(inner):
                break
            node[inner] = left[node[inner]] + (rows[inner, c[inner]] > value[node[inner]])
        total += path[node]
    return 2.0 ** -(total / len(forest.column) / forest.norm)


def _failed_base():
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def fit(counted: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Forest | None:
    """Grow the forest on about ``sample_rows`` rows, by hash, that pass the base rules; None without any."""
    passed = counted.filter(~_failed_base())
    rows = sorted(drawn(passed, sample_rows, "doc_id", *COUNTS).select(*COUNTS, *MORE).collect())
    return grow(features(np.array(rows, np.int64))) if rows else None


def score(counted: DataFrame, forest: Forest | None) -> DataFrame:
    """Add ``anomaly`` to the counts (0 without a forest)."""
    schema = StructType([*counted.schema, StructField("anomaly", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in COUNTS + MORE])
            found = anomaly(forest, features(counts)) if forest else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], schema.names)

    return counted.mapInArrow(run, schema)


def threshold(scored: DataFrame, labels: DataFrame, max_good_loss: float = MAX_GOOD_LOSS) -> float | None:
    """Least score (in steps of 1/BINS) above which at most that share of all good labelled rows lies.

    ``labels``: (doc_id, quality).  Rows that fail the base rules don't count;
    a histogram of BINS steps per label reaches the driver.
    """
    step = F.floor(F.col("anomaly") * BINS).cast("int")
    bins = (scored.filter(~_failed_base()).join(labels.select("doc_id", "quality"), "doc_id")
            .groupBy("quality", step.alias("step")).count().filter("quality is not null").collect())
    good = np.zeros(BINS + 1)
    for row in bins:
        if row["quality"] == 1:
            good[row["step"]] += row["count"]
    if not good.sum() or not any(row["quality"] == 0 for row in bins):
        return None
    above = 1 - np.cumsum(good) / good.sum()
    return float(np.flatnonzero(above <= max_good_loss)[0] + 1) / BINS


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, counts, base_failed, kept and anomaly of every row."""
    counted = write_scratch(statistics(docs), "rules-counts")
    scored = score(counted, fit(counted))
    limit = threshold(scored, labels)
    fails = _failed_base()
    fine = F.lit(True) if limit is None else F.col("anomaly") < limit
    return scored.select("doc_id", *COUNTS, fails.alias("base_failed"), (~fails & fine).alias("kept"), "anomaly")

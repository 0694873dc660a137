"""Helpers shared by the text operators: word spans and hashes, scratch tables.

A *word* is a maximal run of ``[^\\x20\\x09-\\x0D]+``: only the ASCII blanks
separate words, so ``bytes.split()`` on UTF-8 cuts exactly the same words as
the regular expression does on the text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: Java regular expression of a word.
WORD = r"[^\x20\x09-\x0D]+"

U64 = np.uint64
_WORD_BASE = U64(0x9E3779B97F4A7C15)
#: Text bytes handled at once inside a task; bounds the numpy temporaries.
SLICE_BYTES = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64."""
    out = np.empty(max(n, 1), U64)
    out[0] = 1
    out[1:] = U64(base)
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=U64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (xor-shift-multiply rounds)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def write_scratch(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at files
    that every executor sees, so losing one costs a re-read, not a re-run."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unit_hash(*cols: str | Column, seed: int = 0) -> Column:
    """64-bit hash that depends on the values only."""
    return F.xxhash64(F.lit(seed), *[F.col(c) if isinstance(c, str) else c for c in cols])


def drawn(df: DataFrame, wanted: int, *keys: str) -> DataFrame:
    """About ``wanted`` rows of ``df`` (all, if it has no more), by a hash of ``keys``.

    A filter by a share of the hash space: the same rows on any layout, no
    sort, and no task or driver that gathers candidates.  Rows whose first key
    is NULL are left out, as they would be drawn together.
    """
    known = df.filter(F.col(keys[0]).isNotNull())
    rows = known.count()
    if rows <= wanted:
        return known
    return known.filter(F.pmod(unit_hash(*keys), F.lit(1 << 30)) < F.lit(int(wanted / rows * (1 << 30))))


#: Bits of the marks by which ``within`` and ``without`` tell rows apart where they are.
MARK_BITS = 1 << 23


def _marked(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(key, row, marked) of ``rows``, and the distinct ``keys``; the key of an unmarked row is not among them.

    The keys mark places in a bit table of fixed size, which every task gets.
    As marks fill up, more rows are marked that only share a place with a key.
    """
    keys = write_scratch(keys.select(F.col(key).alias("key")).distinct(), "keys")
    place = F.pmod(unit_hash("key"), F.lit(MARK_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    marks = keys.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    placed = rows.select(F.col(key).alias("key"), F.struct("*").alias("row")).withColumn("word", F.shiftright(place, 6))
    marked = F.coalesce(F.col("bits").bitwiseAND(bit) != 0, F.lit(False))
    return placed.join(F.broadcast(marks), "word", "left").select("key", "row", marked.alias("marked")), keys


def within(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is in ``wanted``; only marked rows are shuffled for the exact join."""
    marked, wanted = _marked(rows, wanted, key)
    return marked.filter("marked").join(wanted, "key", "left_semi").select("row.*")


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is not in ``gone``, and those without a key; unmarked rows
    stay where they are, only marked ones are shuffled for the exact join."""
    marked, gone = _marked(rows, gone, key)
    unsure = marked.filter("marked").join(gone, "key", "left_anti")
    return marked.filter(~F.col("marked")).select("row").unionAll(unsure.select("row")).select("row.*")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of ``column`` each."""
    n = batch.num_rows
    if not n:
        return
    ends = np.cumsum(text_lengths(batch.column(column)))
    start = 0
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _offsets(text: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type) else np.int32
    raw = np.frombuffer(text.buffers()[1], kind)
    return raw[text.offset: text.offset + len(text) + 1].astype(np.int64)


def text_lengths(text: pa.Array) -> np.ndarray:
    return np.diff(_offsets(text)) if len(text) else np.zeros(0, np.int64)


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows end to end, and the n + 1 offsets of the rows (null: empty)."""
    if text.null_count:
        text = text.fill_null("")
    if not len(text):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = _offsets(text)
    values = text.buffers()[2]
    data = np.frombuffer(values, np.uint8)[offsets[0]: offsets[-1]] if values is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


class Words(NamedTuple):
    """Words of a batch of documents: byte span and 64-bit hash of each, and where each document's words begin."""

    data: np.ndarray
    docs: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray | None


def word_spans(text: pa.Array, hashes: bool = True, lower: bool = False) -> Words:
    """Words of every row; ``lower`` folds A-Z before hashing (spans stay on the bytes as folded)."""
    data, docs = text_bytes(text)
    if lower:
        data = data.copy()
        data[(data >= 65) & (data <= 90)] += 32
    none = np.zeros(0, np.int64)
    if not len(data):
        return Words(data, docs, none, none, np.zeros(len(docs), np.int64), none.astype(U64))
    inside = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[docs] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, docs)
    if not hashes:
        return Words(data, docs, start, end, first, None)
    if not len(start):
        return Words(data, docs, start, end, first, none.astype(U64))
    length = end - start
    at = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(at, length)
    with np.errstate(over="ignore"):
        terms = (data[inside].astype(U64) + U64(1)) * powers(int(_WORD_BASE), int(length.max()))[place]
        return Words(data, docs, start, end, first, mix64(np.add.reduceat(terms, at)))


def count_words(text: pa.Array) -> np.ndarray:
    """Words in every row, int64."""
    return np.diff(word_spans(text, hashes=False).first)


#: Chunks of a table; beyond so many, chunks grow instead, so the border table on the driver stays bounded.
MOST_CHUNKS = 1 << 20


def chunked(docs: DataFrame, chunk_bytes: int) -> tuple[DataFrame, int]:
    """Deal documents into chunks of consecutive ids with about ``chunk_bytes`` of text each.

    Returns (chunk, doc_id, text) and the size of all text.  Ids are numbers;
    chunks are numbered in their order, from 0.  A chunk is less than one
    document larger than asked for, whatever the lengths: the bytes of every id
    are range-partitioned and added up, and the ids at which running sums pass
    a multiple of ``chunk_bytes`` are the borders.  Rows without an id are dealt
    by content and place into chunks of that size, numbered downwards from -1.
    """
    if docs.schema["doc_id"].dataType.typeName() not in ("byte", "short", "integer", "long", "float", "double", "decimal", "void"):
        raise TypeError("ids must be numbers")
    narrow = docs.select("doc_id", "text")
    lone = F.col("doc_id").isNull()
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).alias("size")
    # the bytes of every id, and of all rows without one
    parted = write_scratch(narrow.groupBy("doc_id").agg(size).repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "chunk-sizes")
    known, unknown = (n or 0 for n in parted.agg(F.sum(F.when(~lone, F.col("size"))), F.sum(F.when(lone, F.col("size")))).first())
    chunk_bytes = max(chunk_bytes, -(-known // MOST_CHUNKS))
    borders: list = []
    if known > chunk_bytes:
        parted = parted.filter(~lone)
        parts = parted.groupBy("part").agg(F.sum("size").alias("whole"))
        ahead = F.sum("whole").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # one row a part
        inside = F.sum("size").over(Window.partitionBy("part").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1))
        running = parted.withColumn("inside", F.coalesce(inside, F.lit(0))).join(parts.select("part", F.coalesce(ahead, F.lit(0)).alias("ahead")), "part")
        chunk = F.floor((F.col("ahead") + F.col("inside")) / chunk_bytes)
        borders = sorted(r[0] for r in running.groupBy(chunk.alias("chunk")).agg(F.min("doc_id")).select("min(doc_id)").collect())

    # a binary search in the JVM; distances from the first id are doubles, which keep their order
    first = borders[0] if borders else 0
    splits = sorted({-math.inf, *(float(b - first) for b in borders[1:]), math.inf})
    far = isinstance(first, int) and max(abs(first), abs(borders[-1]) if borders else 0) >= 1 << 52
    distance = (F.col("doc_id").cast("decimal(20,0)") - F.lit(first).cast("decimal(20,0)")).cast("double") if far else F.col("doc_id").cast("double") - F.lit(float(first))
    numbered = narrow.withColumn("_id", F.coalesce(distance, F.lit(0.0)))
    placed = Bucketizer(splits=splits, inputCol="_id", outputCol="_chunk").transform(numbered) if len(splits) > 2 else numbered.withColumn("_chunk", F.lit(0))
    spread = F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(max(1, -(-unknown // chunk_bytes))))
    return placed.select(F.when(lone, -1 - spread).otherwise(F.col("_chunk").cast("long")).alias("chunk"), "doc_id", "text"), known + unknown

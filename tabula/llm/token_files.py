"""Token files: whole texts as ids, range coded, written and read back with Spark.

Documents go, in ascending order of their ids, into files of consecutive
documents; a file is one row of a Parquet table in a folder that all machines
share: its place, its documents with their id counts, and its content in the
format of ``rangecoder`` (frequencies, then independently reset, checksummed
blocks).  Spark's writer commits whole tasks only, so a lost executor leaves
no half-written file.

Defined results: null and empty texts are the end id alone; rows without
``doc_id`` come first; rows that share one follow each other in the order of
their ids' bytes; an empty table gives no files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import rangecoder
from .common import chunked, slices
from .tokens import TOKEN_SLICE, default_vocabulary, tokenizer

FILE_BYTES = 16 << 20


def tokenized(placed: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """(chunk, doc_id, ids): ids of every whole text and the end id, packed."""
    kind = placed.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(vocabulary)
        for batch in batches:
            for part in slices(batch, "text", TOKEN_SLICE):
                ids, at = encoder.encode_all(part.column("text"))
                ids = np.insert(ids, at[1:], end_id).astype(encoder.dtype, copy=False)
                offsets = ((at + np.arange(len(at))) * encoder.dtype.itemsize).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids))])
                yield pa.RecordBatch.from_arrays([part.column("chunk"), part.column("doc_id"), packed], ["chunk", "doc_id", "ids"])

    return placed.mapInArrow(run, f"chunk long, doc_id {kind}, ids binary")


def write_tokens(docs: DataFrame, path: str, end_id: int = 1, vocabulary: str | None = None, file_bytes: int = FILE_BYTES) -> None:
    """Write (doc_id, text) as token files of about ``file_bytes`` of text each."""
    vocabulary = vocabulary or default_vocabulary()
    placed, _ = chunked(docs, file_bytes)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encode(rows: pa.Table) -> pa.Table:
        dtype = tokenizer(vocabulary).dtype
        rows = rows.take(pc.sort_indices(rows, [("doc_id", "ascending"), ("ids", "ascending")], null_placement="at_start"))
        texts = rows.column("ids").to_pylist()
        ids = np.frombuffer(b"".join(texts), dtype)
        return pa.table({
            "file": rows.column("chunk").combine_chunks()[:1], "n_ids": pa.array([len(ids)], pa.int64()),
            "doc_ids": pa.array([rows.column("doc_id").to_pylist()], pa.list_(rows.column("doc_id").type)),
            "counts": pa.array([[len(x) // dtype.itemsize for x in texts]], pa.list_(pa.int64())),
            "content": pa.array([rangecoder.write_file(ids)], pa.binary())})

    files = tokenized(placed, vocabulary, end_id).groupBy("chunk").applyInArrow(encode, f"file long, n_ids long, doc_ids array<{kind}>, counts array<long>, content binary")
    files.write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType
    schema = StructType([StructField("file", LongType()), StructField("doc_id", kind), *(StructField(c, LongType()) for c in ("local", "n_tokens", "ids_crc32"))])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = rangecoder.read_file(batch.column("content")[row].as_py())
                counts = np.array(batch.column("counts")[row].as_py(), np.int64)
                ends = np.cumsum(counts)
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("file")[row].as_py()] * n, pa.int64()), batch.column("doc_ids")[row].values,
                     pa.array(ends - counts), pa.array(counts), pa.array(crc, pa.int64())], schema.names)

    docs = files.select("file", "doc_ids", "counts", "content").mapInArrow(decode, schema)
    # one number a file; the files' order is the documents'
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("offset"))
    return docs.join(offsets, "file").select("doc_id", (F.col("offset") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")

"""Token counts of documents, kept in a cache of digests.

A count belongs to a text's *normalised* content and to one version of a
tokenizer.  Both are digests: the content's SHA-256 (after what the tokenizer
itself does not tell apart), and one over the vocabulary file, the library and
its version.  ``count_tokens`` joins the documents' digests with the stored
counts, encodes every distinct miss once, appends those counts to the cache
and joins again.  The cache is a Parquet folder that all machines share, with
a part per tokenizer version; it is only ever appended to, by Spark's own
committed writes, and equal rows of two writers count once.

Texts move in one shuffle at most, by digest and only for misses; copies
collapse before it.  What the documents join with is 40 bytes a distinct text.

Defined results: null texts are empty; the empty text has no token; null ids
and repeated rows are rows like others; an empty table gives no rows.  Extra
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, write_scratch

#: Documents above this many tokens are marked.
LIMIT = 4096
#: Segments a worker keeps counts of.
CACHED = 1_000_000

CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"

#: The sign that piece vocabularies write a blank as; a text may hold it as well.
BLANK_SIGN = "▁"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def version(vocabulary: str) -> str:
    """Digest of all that decides a count: library, its version and the vocabulary file."""
    library = "sentencepiece" if vocabulary.endswith(".model") else "tokenizers"
    found = hashlib.sha256(f"{library} {__import__(library).__version__}\n".encode())
    with open(vocabulary, "rb") as file:
        found.update(file.read())
    return found.hexdigest()


class _Segments(dict):
    """Number of pieces of a segment: blanks, then what follows up to the next blank."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, segment: str) -> int:
        # encoding puts one blank in front; a lone blank is a piece
        self[segment] = found = len(self.encode(segment[1:])) if len(segment) > 1 else 1
        return found


def _separable(model) -> bool:
    """True if no piece can reach across the start of a run of blanks, so counts of segments add up."""
    from sentencepiece import sentencepiece_model_pb2 as spec

    known = spec.ModelProto.FromString(model.serialized_model_proto())
    normal, kinds = known.normalizer_spec, spec.ModelProto.SentencePiece
    plain = normal.name == "identity" and normal.add_dummy_prefix and normal.escape_whitespaces and not normal.remove_extra_whitespaces
    pieces = [p for p in known.pieces if p.type != kinds.CONTROL]
    return (plain and known.trainer_spec.model_type == spec.TrainerSpec.BPE and not known.trainer_spec.treat_whitespace_as_suffix
            and any(p.piece == BLANK_SIGN for p in pieces)
            and not any(p.type == kinds.USER_DEFINED or BLANK_SIGN in p.piece.lstrip(BLANK_SIGN) for p in pieces))


def _pieces(vocabulary: str) -> Callable[[list[str]], list[int]]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    if not _separable(model):
        return lambda texts: [len(model.encode(t)) for t in texts]
    segments, split = _Segments(model.encode), re.compile(r" *[^ ]+| +").findall

    def count(texts: list[str]) -> list[int]:
        if len(segments) > CACHED:
            segments.clear()
        return [sum(map(segments.__getitem__, split(" " + t.replace(BLANK_SIGN, " ")))) if t else 0 for t in texts]

    return count


def _merged(vocabulary: str) -> Callable[[list[str]], list[int]]:
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(vocabulary)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(e.ids) for e in model.encode_batch(texts, add_special_tokens=False)]


_LOADED: dict[str, Callable[[list[str]], list[int]]] = {}


def counter(vocabulary: str) -> Callable[[list[str]], list[int]]:
    """The worker's function from texts to numbers of tokens, loaded once."""
    if vocabulary not in _LOADED:
        _LOADED[vocabulary] = (_pieces if vocabulary.endswith(".model") else _merged)(vocabulary)
    return _LOADED[vocabulary]


def normalised(text: Column, vocabulary: str) -> Column:
    """What the tokenizer sees of a text: null is empty, and piece vocabularies write a blank as their sign for it."""
    known = F.coalesce(text, F.lit(""))
    return F.replace(known, F.lit(BLANK_SIGN), F.lit(" ")) if vocabulary.endswith(".model") else known


def encode_counts(texts: DataFrame, vocabulary: str) -> DataFrame:
    """(digest, n_tokens) of (digest, text) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array(count(part.column("text").to_pylist()), pa.int64())], ["digest", "n_tokens"])

    return texts.select("digest", "text").mapInArrow(run, "digest binary, n_tokens long")


def cached(spark, path: str, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) that the cache at ``path`` holds for a tokenizer version; equal rows appear once."""
    rows = spark.read.schema(CACHE_SCHEMA).parquet(path).filter(F.col("tokenizer") == tokenizer)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def append(counts: DataFrame, path: str, tokenizer: str) -> None:
    """Add (digest, n_tokens) rows of a tokenizer version to the cache; an empty frame makes the folder."""
    counts.select("digest", "n_tokens", F.lit(tokenizer).alias("tokenizer")).write.partitionBy("tokenizer").mode("append").parquet(path)


def count_tokens(docs: DataFrame, cache: str, vocabulary: str | None = None, limit: int = LIMIT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    ``cache`` is a path in shared storage; it may be new.  The counts that were
    missing are in it afterwards.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()
    tokenizer = version(vocabulary)
    text = normalised(F.col(text_col), vocabulary)
    size = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long")
    digest = F.unhex(F.sha2(text, 256))
    keyed = write_scratch(docs.select(F.col(id_col).alias("doc_id"), digest.alias("digest"), size.alias("n_bytes")), "count-keys")

    append(spark.createDataFrame([], "digest binary, n_tokens long"), cache, tokenizer)
    texts = docs.select(digest.alias("digest"), text.alias("text"))
    known = cached(spark, cache, tokenizer)
    if not known.isEmpty():
        missing = write_scratch(keyed.select("digest").distinct().join(known, "digest", "left_anti"), "count-misses")
        texts = texts.join(missing, "digest", "left_semi")
    append(encode_counts(texts.dropDuplicates(["digest"]), vocabulary), cache, tokenizer)

    # the counts in use as a plain table: a text with very many copies is then a skewed join that Spark splits
    wanted = keyed.select("digest").distinct()
    counts = write_scratch(cached(spark, cache, tokenizer).join(wanted, "digest", "left_semi"), "count-hits")
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

"""Language identification with language-bitmask n-gram filters.

The training languages' characteristic character trigrams go into Bloom
filters that share their hash functions and are sliced by bit: a slot is a
mask with one bit per language, and the AND of an n-gram's slots is the mask
of all languages that contain it, one look-up for all.  A text's languages
are counted over its n-grams, and each count is corrected for the language's
false-positive rate, which its filled slots give.

The model is fitted on a bounded sample: about ``max_docs`` labelled rows a
language, drawn by hash of their id.  Every document is then classified
over its whole text.

Defined results: null texts and texts without a letter are ``und`` with score
0; where no n-gram is known, the language with most training documents wins
with score 0; ties go to the earlier code; without training rows everything
is ``und``; equal texts get equal results.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import U64, mix64, powers, slices, unit_hash

ORDER = 3
MAX_DOCS = 1000
TOP = 4000
LEAST_SHARE = 0.3
SLOT_BITS = 16
HASHES = 3
_GRAM_BASE = 0x9FB21C651E98DF25
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For every code point, whether it is a letter; made once a worker."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)]))
    return _LETTERS[0]


def held_out(id_col: str = "doc_id"):
    """Rows kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Grams(NamedTuple):
    hash: np.ndarray
    first: np.ndarray
    letters: np.ndarray


def grams(text: pa.Array) -> Grams:
    """Hashes of the n-grams of each text, lower-cased, other characters than letters as blanks."""
    texts = [(x or "").replace("\0", " ").lower() for x in text.to_pylist()]
    # each text gets a blank on both sides; n-grams with two blanks in a row fall away, and with them those across texts
    code = np.frombuffer("".join(f"\0{x}\0" for x in texts).encode("utf-32-le", "replace"), "<u4")
    ends = np.cumsum([len(x) + 2 for x in texts])
    letter = _letters()[code]
    n = max(len(code) - ORDER + 1, 0)
    code = np.where(letter, code, 0).astype(U64)
    hashed, ok = np.zeros(n, U64), np.ones(n, bool)
    with np.errstate(over="ignore"):
        for j, factor in enumerate(powers(_GRAM_BASE, ORDER)):
            hashed += code[j: j + n] * factor
            if j:
                ok &= letter[j: j + n] | letter[j - 1: j - 1 + n]
        hashed = mix64(hashed[ok])
    before = np.concatenate([[0], np.cumsum(ok)])
    first = before[np.minimum(np.concatenate([[0], ends]), n)]
    count = np.concatenate([[0], np.cumsum(letter)])[np.concatenate([[0], ends])]
    return Grams(hashed, first, np.diff(count))


class Model(NamedTuple):
    langs: list[str]
    planes: np.ndarray  # (language groups of 64, slots)
    false_positive: np.ndarray
    default: int


def _slots(hashed: np.ndarray) -> list[np.ndarray]:
    return [(hashed >> U64(SLOT_BITS * k)) & U64((1 << SLOT_BITS) - 1) for k in range(HASHES)]


def train(rows: DataFrame, max_docs: int = MAX_DOCS, top: int = TOP) -> Model:
    """Fit on (doc_id, text, lang); rows without id, text or lang teach nothing.

    Only the chosen n-grams, ``top`` a language, reach the driver.
    """
    # rows without id would be drawn together
    rows = rows.filter("doc_id is not null and text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    # a share of each language's rows by a hash of the id: no shuffle, and no task that gathers a language
    shares = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, max_docs / n)))]) if sizes else None
    drawn = F.pmod(unit_hash("doc_id"), F.lit(1 << 30)) < F.element_at(shares, F.col("lang")) * (1 << 30) if sizes else F.lit(False)
    sample = rows.filter(drawn)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found, lang = grams(part.column("text")), part.column("lang")
                owner = np.repeat(np.arange(part.num_rows), np.diff(found.first))
                names = lang.dictionary_encode()
                kind = names.indices.to_numpy(zero_copy_only=False)[owner]
                for k, name in enumerate(names.dictionary.to_pylist()):
                    values, times = np.unique(found.hash[kind == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(values), pa.string()), pa.array(values.view(np.int64)), pa.array(times.astype(np.int64))], ["lang", "gram", "n"])

    counted = sample.select("text", "lang").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("lang"))
    best = F.max("share").over(Window.partitionBy("gram"))
    leading = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    kept = counted.withColumn("share", share).withColumn("best", best).filter(F.col("share") >= F.col("best") * LEAST_SHARE).withColumn("place", leading).filter(F.col("place") <= top)
    by_lang: dict[str, list[int]] = {}
    for row in kept.select("lang", "gram").collect():
        by_lang.setdefault(row["lang"], []).append(row["gram"])
    langs = sorted(sizes)
    planes = np.zeros((max(1, -(-len(langs) // 64)), 1 << SLOT_BITS), U64)
    filled = np.zeros(len(langs))
    for k, lang in enumerate(langs):
        hashed = np.array(by_lang.get(lang, []), np.int64).view(U64)
        for slot in _slots(hashed):
            planes[k // 64][slot] |= U64(1 << (k % 64))
        filled[k] = (planes[k // 64] >> U64(k % 64) & U64(1)).mean()
    return Model(langs, planes, filled ** HASHES, max(range(len(langs)), key=lambda k: sizes[langs[k]], default=0))


def shares(found: Grams, model: Model) -> np.ndarray:
    """(texts, languages): corrected share of each text's n-grams that the language contains."""
    total = np.diff(found.first)
    out = np.zeros((len(total), len(model.langs)))
    slots = _slots(found.hash)
    for p, plane in enumerate(model.planes):
        masks = plane[slots[0]]
        for slot in slots[1:]:
            masks &= plane[slot]
        for k in range(p * 64, min(len(model.langs), p * 64 + 64)):
            hits = np.concatenate([[0], np.cumsum((masks >> U64(k - p * 64)) & U64(1), dtype=np.int64)])
            out[:, k] = hits[found.first[1:]] - hits[found.first[:-1]]
    out /= np.maximum(total, 1)[:, None]
    return np.clip((out - model.false_positive) / (1 - model.false_positive), 0, 1)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``lang_pred``, ``score`` (share of the text's n-grams that the language contains) and
    ``margin`` (lead over the next); columns of these names are replaced."""
    docs = docs.drop("lang_pred", "score", "margin")
    schema = StructType([*docs.schema, StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("margin", DoubleType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = grams(part.column("text"))
                known = (found.letters > 0) & bool(model.langs)
                if model.langs:
                    share = shares(found, model)
                    best = share.argmax(1)
                    score = share.max(1)
                    next_ = np.sort(share, axis=1)[:, -2] if share.shape[1] > 1 else np.zeros(len(score))
                    best[score == 0] = model.default
                    names = np.array(model.langs, object)[best]
                else:
                    names, score, next_ = np.full(part.num_rows, "und", object), np.zeros(part.num_rows), np.zeros(part.num_rows)
                names = np.where(known, names, "und")
                score, next_ = np.where(known, score, 0.0), np.where(known, next_, 0.0)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names.tolist(), pa.string()), pa.array(score), pa.array(score - next_)], [*part.schema.names, "lang_pred", "score", "margin"])

    return docs.mapInArrow(predict, schema)

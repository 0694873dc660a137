"""Token ids of whole texts from a public vocabulary, cached by word.

The vocabulary's tokenizer never joins anything across ASCII blanks, so the
ids of a text are the ids of its blank-separated chunks end to end.  The
distinct chunks of a batch are looked up once in a bounded cache that each
Python worker keeps, which spares most calls into the tokenizer library;
results are those of encoding the whole text.
"""

from __future__ import annotations

import string
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import text_bytes

#: Text bytes that are encoded together.
TOKEN_SLICE = 2 << 20
_LOADED: dict[str, "ChunkTokenizer"] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_signs() -> dict[int, str]:
    """The characters that byte-level vocabularies write bytes as: printable Latin-1 as itself, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b < 127 or b >= 161 and b != 173]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}


_SIGNS = _byte_signs()
_STOP, _LETTER, _GAP = (np.isin(np.arange(256), list(x)) for x in (b".,", string.ascii_letters.encode(), b" \t\n\r\x0b\x0c"))
_MARKS = "".join(c for c in string.punctuation if c != "'")


class _Chunks(dict):
    """Chunk of UTF-8 bytes -> its ids as bytes; asks the tokenizer for unknown chunks.

    ``older``: the cache before this one, so frequent chunks outlive a full cache.
    """

    def __init__(self, tokenizer, dtype, older: dict[bytes, bytes] | None = None):
        super().__init__()
        self.older = {} if older is None else older
        self.tokenizer, self.model, self.letter = tokenizer, tokenizer.model, {2: "H", 4: "I"}[dtype.itemsize]
        self.lowered = type(tokenizer.normalizer).__name__ == "Sequence" and tokenizer.normalizer.normalize_str("AÉß") == "aéß"

    def __missing__(self, chunk: bytes) -> bytes:
        if (ids := self.older.get(chunk)) is not None:
            pass
        elif self.lowered and chunk.isalpha():  # ASCII letters stand for themselves and are one piece: the merges alone
            ids = array(self.letter, [t.id for t in self.model.tokenize(chunk.decode().lower())]).tobytes()
        else:
            text = chunk.decode("utf-8", "replace")
            stem = text.rstrip(_MARKS)
            if stem != text and stem[-1:].isalpha() and stem[-1] < "\u0100" and "<|" not in text:
                # marks after a letter, an apostrophe aside, are pieces of their own
                ids = self[stem.encode()] + self[text[len(stem):].encode()]
            elif self.lowered and text.isalpha() and max(text) < "\u0100":
                ids = array(self.letter, [t.id for t in self.model.tokenize(text.lower().encode().decode("latin-1").translate(_SIGNS))]).tobytes()
            else:
                ids = array(self.letter, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        self[chunk] = ids
        return ids


class ChunkTokenizer:
    """Encoder with a cache of at most about ``limit`` chunks."""

    def __init__(self, path: str, limit: int = 500_000):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.size = tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.limit, self.chunks = limit, _Chunks(tokenizer, self.dtype)

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.string()))[0]

    def encode_all(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the n + 1 offsets of the texts (null: empty)."""
        text = text.fill_null("") if text.null_count else text
        # the vocabulary lower-cases; without combining marks (so within Latin-1) or special
        # tokens, doing so for A-Z beforehand changes nothing
        data, docs = text_bytes(text)
        odd = pc.match_substring(text, "<|").to_numpy(zero_copy_only=False)
        odd[np.searchsorted(docs, np.flatnonzero(data >= 0xC4), "right") - 1] = True
        lowered = pc.ascii_lower(text)
        words = pc.ascii_split_whitespace(_marks_apart(pc.if_else(pa.array(odd), text, lowered) if odd.any() else lowered))
        found = words.flatten().dictionary_encode()
        if 3 * len(self.chunks) > self.limit:  # two caches, and what a batch adds to each
            self.chunks.older = {}
            self.chunks = _Chunks(self.chunks.tokenizer, self.dtype, self.chunks)
        # by way of numpy, as to_pylist boxes every value
        ids = list(map(self.chunks.__getitem__, found.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()))
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        table = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), self.dtype)))
        at = np.concatenate([[0], np.cumsum(size[found.indices.to_numpy()])])
        return table.take(found.indices).flatten().to_numpy(), at[words.offsets.to_numpy() - words.offsets[0].as_py()]


def _marks_apart(text: pa.Array) -> pa.Array:
    """A blank before every stop or comma that ends a chunk after an ASCII letter: it is a piece of its own."""
    data, docs = text_bytes(text)
    at = np.flatnonzero(_STOP[data])
    at = at[(at > 0) & (at + 1 < len(data))]
    at = at[_LETTER[data[at - 1]] & _GAP[data[at + 1]]]
    at = at[docs[np.searchsorted(docs, at, "right") - 1] < at]  # the letter is of the same text
    ends = docs + np.searchsorted(at, docs)
    return pa.Array.from_buffers(pa.large_string(), len(text), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.insert(data, at, 32))])


def tokenizer(path: str) -> ChunkTokenizer:
    """The worker's encoder for ``path``, loaded once."""
    if path not in _LOADED:
        _LOADED[path] = ChunkTokenizer(path)
    return _LOADED[path]

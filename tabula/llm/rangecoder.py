"""Adaptive context-mixing range coder for token ids, on many blocks at once.

A block's ids are coded one after the other; numpy steps through all blocks
of a file together, so the cost of a step is shared by hundreds of blocks.
Each id's chance mixes three predictions:

* order 0: the file's id frequencies, from its header;
* order 1: the id that last followed the previous id in this block;
* order 2: the id that last followed the previous two.

Mixing weights follow how often orders 1 and 2 were right of late.  All of
this is reset for every block, and each block has its own checksum, so blocks
decode alone.  The cumulative chance of an id is an integer,

    w0 * F0(id) + w1 * [guess1 < id] + w2 * [guess2 < id]    out of 2**24,

which the encoder adds up and the decoder solves for the id.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK_IDS = 4096
MIX_BITS = 24
CONTEXT_BITS = 10
#: Steps between renewals of the mixing weights.
TURN = 16
_I = np.int64
_CONTEXT = _I((1 << CONTEXT_BITS) - 1)
_LEAST = _I(1 << 32)
_LOW32 = _I((1 << 32) - 1)
_HEAD = struct.Struct("<4sBBIIQ")
_PART = struct.Struct("<IIII")
MAGIC = b"TIDX"


class Prior:
    """Order-0 frequencies, scaled to a power of two; every id that occurs has a share."""

    def __init__(self, ids: np.ndarray, times: np.ndarray):
        self.bits = 16 if len(ids) <= 1 << 15 else 20
        if len(ids) > 1 << 19:
            raise ValueError("more than 524288 distinct ids in a file")
        spare = (1 << self.bits) - len(ids)
        share = 1 + (times.astype(float) * spare / max(times.sum(), 1)).astype(_I)
        if len(ids):
            share[int(times.argmax())] += (1 << self.bits) - share.sum()
        self.ids, self.share = ids, share

    @classmethod
    def of_shares(cls, ids: np.ndarray, share: np.ndarray) -> "Prior":
        out = cls.__new__(cls)
        out.bits, out.ids, out.share = (16 if len(ids) <= 1 << 15 else 20), ids, share.astype(_I)
        return out

    def kind(self) -> type:
        """The smallest type that holds a place in ``ids``."""
        return np.uint16 if len(self.ids) <= 1 << 16 else np.int32

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Share and cumulative share by place in ``ids``, and the place of every slot."""
        return self.share, np.concatenate([[0], np.cumsum(self.share)[:-1]]).astype(_I), np.repeat(np.arange(len(self.ids)), self.share)


def _slots(symbols: np.ndarray, before: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the order-1 and order-2 contexts that end with ``symbols``, in tables of all blocks."""
    near = symbols * 40503 >> 3
    return base + (near & _CONTEXT), base + (near * 31 + before * 27191 & _CONTEXT)


class _Weights:
    """Mixing weights of the blocks, in units of which ``unit`` make the whole; renewed every TURN steps."""

    def __init__(self, lanes: int, prior: Prior):
        self.unit, self.shift = 1 << (MIX_BITS - prior.bits), prior.bits
        self.right = np.full((2, lanes), 1 << 12, _I)
        self._set()

    def _set(self) -> None:
        part = self.right * (self.unit * 3 // 8) >> 16
        self.w0 = self.unit - part[0] - part[1]
        self.w1, self.w2 = part << self.shift

    def renew(self, hits1: np.ndarray, hits2: np.ndarray) -> None:
        """``hits``: how many of the last TURN guesses were right, by block."""
        self.right += ((np.stack([hits1, hits2]) << 16) // TURN - self.right) >> 1
        self._set()

    def shrink(self, lanes: int) -> None:
        self.right = self.right[:, :lanes]
        self._set()


def _columns(symbols: np.ndarray, block: int) -> np.ndarray:
    """Symbols with one row per step and one column per block, zero-filled."""
    lanes = -(-len(symbols) // block)
    whole = np.zeros(lanes * block, _I)
    whole[: len(symbols)] = symbols
    return np.ascontiguousarray(whole.reshape(lanes, block).T)


def _guesses(steps: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """What orders 1 and 2 guess at every step of every block."""
    rows, lanes = steps.shape
    base = np.arange(lanes, dtype=_I) << CONTEXT_BITS
    # small tables: every step looks up and writes one entry a block, and caches hold them
    tables = np.zeros((2, lanes << CONTEXT_BITS), kind)
    out = np.empty((2, rows, lanes), kind)
    before = last = np.zeros(lanes, _I)
    slot1, slot2 = base, base
    for step in range(rows):
        x = steps[step]
        out[0, step], out[1, step] = tables[0][slot1], tables[1][slot2]
        tables[0][slot1] = x
        tables[1][slot2] = x
        before, last = last, x
        slot1, slot2 = _slots(last, before, base)
    return out[0], out[1]


def encode_blocks(symbols: np.ndarray, prior: Prior, block: int) -> list[bytes]:
    if not len(symbols):
        return []
    steps = _columns(symbols, block)
    lanes, tail = steps.shape[1], len(symbols) - (steps.shape[1] - 1) * block
    share, below, _ = prior.tables()
    all1, all2 = _guesses(steps, prior.kind())
    weights = _Weights(lanes, prior)
    low, span = np.zeros(lanes, _I), np.full(lanes, (1 << 48) - 1, _I)
    width = block * 2 + 8
    out, at = np.zeros(lanes * width, np.uint32), np.arange(lanes, dtype=_I) * width
    first, held = at.copy(), None
    for turn in range(0, block, TURN):
        rows = slice(turn, turn + TURN)
        for step in range(turn, min(turn + TURN, block)):
            if step == tail and tail < block:  # the last block is shorter: set its state aside
                held = low[-1:].copy(), at[-1:].copy()
                lanes -= 1
                weights.shrink(lanes)
                low, span, at = low[:lanes], span[:lanes], at[:lanes]
            if not lanes:
                break
            if step == turn or step == tail:  # chances of the turn's ids, while the weights stay
                x, one, two = (m[rows, :lanes] for m in (steps, all1, all2))
                hit1, hit2 = one == x, two == x
                starts = weights.w0 * below[x] + weights.w1 * (one < x) + weights.w2 * (two < x)
                widths = weights.w0 * share[x] + weights.w1 * hit1 + weights.w2 * hit2
            scale = span >> MIX_BITS
            low = low + scale * starts[step - turn]
            span = scale * widths[step - turn]
            need = span < _LEAST
            out[at] = low >> 32  # 16 bits and maybe a carry; overwritten unless they are due
            at = at + need
            grow = need * _I(16)
            low = np.where(need, low & _LOW32, low) << grow
            span = span << grow
            if (span < _LEAST).any():
                few = np.flatnonzero(span < _LEAST)
                out[at[few]] = low[few] >> 32
                at[few] += 1
                low[few] = (low[few] & _LOW32) << 16
                span[few] <<= 16
        if not lanes:
            break
        weights.renew(hit1.sum(0), hit2.sum(0))
    if held is not None:
        low, at = np.concatenate([low, held[0]]), np.concatenate([at, held[1]])
    for _ in range(3):
        out[at] = low >> 32
        at = at + 1
        low = (low & _LOW32) << 16
    words = out.reshape(-1, width)
    used = at - first
    carry = np.zeros(len(words), np.uint32)
    sums = np.ascontiguousarray(words.T)
    for column in range(int(used.max()) - 1, -1, -1):
        whole = sums[column] + carry
        sums[column] = whole & np.uint32(0xFFFF)
        carry = whole >> np.uint32(16)
    words = sums.T.astype("<u2")
    return [row[:n].tobytes() for row, n in zip(words, used.tolist(), strict=True)]


def decode_blocks(parts: list[bytes], counts: list[int], prior: Prior) -> np.ndarray:
    """Symbols of the blocks, end to end.  All blocks but the last have equal counts.

    Quotients are taken in doubles: numerators stay under 2**48 and quotients
    under 2**25, so rounding can't lift one to the next integer.
    """
    if not parts:
        return np.zeros(0, _I)
    share, below, place = prior.tables()
    lanes, block, tail = len(parts), counts[0], counts[-1]
    width = max(map(len, parts)) // 2 + 4
    words = np.zeros((lanes, width), np.uint16)
    for row, part in enumerate(parts):
        words[row, : len(part) // 2] = np.frombuffer(part, "<u2")
    words = words.reshape(-1).astype(_I)
    at = np.arange(lanes, dtype=_I) * width
    code = (words[at] << 32) | (words[at + 1] << 16) | words[at + 2]
    at += 3
    span = np.full(lanes, (1 << 48) - 1, _I)
    weights = _Weights(lanes, prior)
    base = np.arange(lanes, dtype=_I) << CONTEXT_BITS
    one_of, two_of = np.zeros((2, lanes << CONTEXT_BITS), prior.kind())
    before = last = np.zeros(lanes, _I)
    slot1, slot2 = base, base
    out = np.zeros((block, lanes), prior.kind())
    hits = np.zeros((2, TURN, lanes), bool)
    most, end = _I((1 << MIX_BITS) - 1), len(place) - 1
    for turn in range(0, block, TURN):
        hits[:] = False
        for step in range(turn, min(turn + TURN, block)):
            if step == tail and tail < block:
                lanes -= 1
                weights.shrink(lanes)
                hits, code, span, at, base, before, last, slot1, slot2 = (m[..., :lanes] for m in (hits, code, span, at, base, before, last, slot1, slot2))
            if not lanes:
                break
            if step == turn or step == tail:
                w0, w1, w2, w0_float, w12 = weights.w0, weights.w1, weights.w2, weights.w0.astype(float), weights.w1 + weights.w2
            one, two = one_of[slot1].astype(_I), two_of[slot2].astype(_I)
            scale = span >> MIX_BITS
            target = np.minimum((code / scale).astype(_I), most)
            from1, from2 = w0 * below[one] + w2 * (two < one), w0 * below[two] + w1 * (one < two)
            both = (one == two) * w12
            past1 = target - from1 - w0 * share[one] - np.maximum(w1, both)
            past2 = target - from2 - w0 * share[two] - np.maximum(w2, both)
            # outside the guesses' own stretches, the ids' shares are all that is left
            rest = target - w1 * (past1 >= 0) - w2 * (past2 >= 0)
            x = place[np.minimum((rest / w0_float).astype(_I), end)]
            # a target inside a guess's own stretch is that guess
            for guess, start, past in ((two, from2, past2), (one, from1, past1)):
                x = np.where((target >= start) & (past < 0), guess, x)
            out[step, :lanes] = x
            hit1, hit2 = one == x, two == x
            hits[0, step - turn], hits[1, step - turn] = hit1, hit2
            code = code - scale * (w0 * below[x] + w1 * (one < x) + w2 * (two < x))
            span = scale * (w0 * share[x] + w1 * hit1 + w2 * hit2)
            need = span < _LEAST
            grow = need * _I(16)
            code = (code << grow) | np.where(need, words[at], 0)
            span = span << grow
            at = at + need
            if (span < _LEAST).any():
                few = np.flatnonzero(span < _LEAST)
                code[few] = code[few] << 16 | words[at[few]]
                at[few] += 1
                span[few] <<= 16
            one_of[slot1] = x
            two_of[slot2] = x
            before, last = last, x
            slot1, slot2 = _slots(last, before, base)
        if not lanes:
            break
        weights.renew(hits[0].sum(0), hits[1].sum(0))
    return out.T.reshape(-1)[: (len(parts) - 1) * block + tail].astype(_I)


def write_file(ids: np.ndarray, block: int = BLOCK_IDS) -> bytes:
    """Ids as a file: header, checksummed frequencies, then blocks of (ids, bytes, checksums of ids and code, code)."""
    if len(ids) and int(ids.max()) < 1 << 24:
        times = np.bincount(ids)
        found = np.flatnonzero(times)
        symbols, times = (np.cumsum(times > 0) - 1)[ids], times[found]
    else:
        found, symbols, times = np.unique(ids, return_inverse=True, return_counts=True)
    prior = Prior(found.astype("<u4"), times)
    table = zlib.compress(prior.ids.astype("<u4").tobytes() + prior.share.astype("<u4").tobytes(), 1)
    parts = encode_blocks(symbols.astype(_I), prior, block)
    out = [_HEAD.pack(MAGIC, 1, prior.bits, len(table), zlib.crc32(table), len(ids)), table]
    for n, part in enumerate(parts):
        own = ids[n * block: (n + 1) * block]
        out += [_PART.pack(len(own), len(part), zlib.crc32(own.astype("<u4").tobytes()), zlib.crc32(part, len(own))), part]
    return b"".join(out)


def read_file(raw: bytes) -> np.ndarray:
    """The ids of a file, uint32; raises ValueError where a checksum fails."""
    magic, version, _, table_size, table_crc, total = _HEAD.unpack_from(raw)
    if magic != MAGIC or version != 1:
        raise ValueError("not a token file")
    at = _HEAD.size
    table = raw[at: at + table_size]
    if zlib.crc32(table) != table_crc:
        raise ValueError("damaged frequency table")
    numbers = np.frombuffer(zlib.decompress(table), "<u4")
    prior = Prior.of_shares(numbers[: len(numbers) // 2], numbers[len(numbers) // 2:])
    at += table_size
    parts, counts, sums = [], [], []
    while at < len(raw):
        if at + _PART.size > len(raw):
            raise ValueError("a block is cut off")
        count, size, crc, code_crc = _PART.unpack_from(raw, at)
        at += _PART.size
        parts.append(raw[at: at + size])
        if zlib.crc32(parts[-1], count) != code_crc:
            raise ValueError(f"block {len(parts) - 1} is damaged")
        counts.append(count)
        sums.append(crc)
        at += size
    if sum(counts) != total:
        raise ValueError("blocks are missing")
    ids = prior.ids[decode_blocks(parts, counts, prior)].astype("<u4") if parts else np.zeros(0, "<u4")
    ends = np.cumsum(counts)
    for n, (end, count, crc) in enumerate(zip(ends.tolist(), counts, sums, strict=True)):
        if zlib.crc32(ids[end - count: end].tobytes()) != crc:
            raise ValueError(f"block {n} is damaged")
    return ids

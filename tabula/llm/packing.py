"""Packing token pieces into sequences by swap-based local search.

Documents are tokenized whole and only those longer than a sequence are cut.
Pieces go by hash into groups of bounded size; each group is packed on its
own: best fit by decreasing length first, then a local search over the
sequences that are not full.  It moves a document, exchanges one for one or
two for one, always so that the sum of squared fills grows; that drains the
emptiest sequence until it is gone or no exchange helps.  What a group leaves
in sequences that are at most half full is packed again with the leftovers of
other groups, level by level, until one group has them all; so the whole
wastes less than a sequence or two over its lower bound in practice.

Ids never leave Arrow, so they come back as they were, nulls beside them or
not.  Defined results: null and empty texts are the end id alone; null ids and
repeated rows are pieces like others (rows without id are dealt into groups by
their places in the written piece table); an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, unit_hash, write_scratch
from .tokens import TOKEN_SLICE, default_vocabulary, tokenizer

CAPACITY = 2048
GROUP = 20_000


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, vocabulary: str | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the pieces of every whole text and its end id."""
    vocabulary = vocabulary or default_vocabulary()
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(vocabulary)
        for batch in batches:
            for part in slices(batch, "text", TOKEN_SLICE):
                rows, piece, start, length, crc = [], [], [], [], []
                flat, ends = encoder.encode_all(part.column("text"))
                flat = np.insert(flat, ends[1:], end_id).astype("<u4")
                ends = ends + np.arange(len(ends))
                for row, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
                    ids = flat[a:b]
                    for n, at in enumerate(range(0, len(ids), capacity)):
                        some = ids[at: at + capacity]
                        rows.append(row)
                        piece.append(n)
                        start.append(at)
                        length.append(len(some))
                        crc.append(zlib.crc32(some.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                     *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best fit by decreasing length: bins as lists of item numbers."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set while some bin has room r
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        wide = rooms >> size
        if wide:
            room = size + (wide & -wide).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[number].append(item)
        else:
            room, number = capacity, len(bins)
            bins.append([item])
        by_room[room - size].append(number)
        rooms |= 1 << (room - size)
    return bins


def improve(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Local search over the underfull bins; every step raises the sum of squared fills, so it ends.

    Bins give in turn, the emptiest first; one that runs empty is gone.
    """
    least = -(-int(lengths.sum()) // capacity)
    fill = [int(lengths[b].sum()) for b in bins]
    full = [b for b, f in zip(bins, fill, strict=True) if f == capacity]
    open_ = [list(b) for b, f in zip(bins, fill, strict=True) if f != capacity]
    moved = True
    while moved and len(full) + len(open_) > least and len(open_) > 1:
        moved = False
        open_.sort(key=lambda b: (int(lengths[b].sum()), b))
        for donor in open_:
            if _give(donor, [b for b in open_ if b is not donor], lengths, capacity):
                moved = True
                if not donor:
                    break
        open_ = [b for b in open_ if b]
    return full + open_


def _give(donor: list[int], others: list[list[int]], lengths: np.ndarray, capacity: int) -> bool:
    """Exchange items of ``donor`` with the others as long as that helps; True if anything moved."""
    room = np.array([capacity - int(lengths[b].sum()) for b in others])
    items = np.array([i for b in others for i in b], np.int64)
    owner = np.repeat(np.arange(len(others)), [len(b) for b in others])
    moved = False
    while donor and (step := _step(donor, lengths, room, items, owner, capacity)) is not None:
        out, at, to = step
        moved = True
        for i in out:
            donor.remove(i)
            others[to].append(i)
        if at is not None:
            back = int(items[at])
            others[to].remove(back)
            donor.append(back)
            items, owner = np.delete(items, at), np.delete(owner, at)
            room[to] += lengths[back]
        room[to] -= int(lengths[list(out)].sum())
        items, owner = np.append(items, out), np.append(owner, [to] * len(out))
    return moved


def _step(donor: list[int], lengths: np.ndarray, room: np.ndarray, items: np.ndarray, owner: np.ndarray, capacity: int):
    """The exchange that fills most: (items that leave the donor, place of the item that comes back or None, bin).

    The squares of the two fills grow if the other bin ends up fuller than the donor began.
    """
    own = int(lengths[donor].sum())
    one_of = {int(lengths[i]): i for i in donor}  # equal lengths are alike
    sizes = sorted(one_of, reverse=True)
    for x in sizes:  # a move, the longest that fits
        able = (room >= x) & (capacity - room + x > own)
        if able.any():
            return (one_of[x],), None, int(np.where(able, room, capacity + 1).argmin())
    size, space = lengths[items], room[owner] + lengths[items]
    before = capacity - room[owner]
    choices = [((one_of[x],), x) for x in sizes]
    for n, x in enumerate(sizes):
        for y in sizes[n:]:
            pair = (one_of[x], one_of[y]) if x != y else tuple(i for i in donor if lengths[i] == x)[:2]
            if len(pair) == 2:
                choices.append((pair, x + y))
    best, most = None, 0
    for out, x in choices:  # one for one, two for one
        gain = np.where((space >= x) & (before + x - size > own), x - size, 0)
        at = int(gain.argmax()) if len(gain) else 0
        if len(gain) and gain[at] > most:
            best, most = (out, at, int(owner[at])), int(gain[at])
    return best


def pack(cut: DataFrame, capacity: int = CAPACITY, group: int = GROUP, seed: int = 42) -> DataFrame:
    """Add ``sequence_id`` and a gapless ``offset`` from 0 to pieces with a ``length``.

    A group is a hash class of about ``group`` pieces, packed in one task; the
    number of groups grows with the input.  ``sequence_id`` is made of level,
    group and number.
    """
    columns = cut.columns
    keys = [c for c in ("doc_id", "piece") if c in columns]
    row = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()) if "doc_id" in columns else F.monotonically_increasing_id()
    left = write_scratch(cut.withColumn("_row", row), "pack-pieces")
    schema = left.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(False).alias("_loose")).schema
    done: list[DataFrame] = []
    count, level, groups = left.count(), 0, None
    while True:
        most = -(-count // group)
        groups = max(1, most if groups is None else min(most, groups - 1))
        dealt = left.withColumn("_group", F.pmod(unit_hash(*keys, "_row", seed=seed + level), F.lit(groups)))
        packed = dealt.groupBy("_group").applyInArrow(_packed(capacity, level, groups == 1, schema.names), schema)
        if groups == 1 and not done:
            return packed.select(*columns, "sequence_id", "offset")
        packed = write_scratch(packed, f"pack-level{level}")
        done.append(packed.filter(~F.col("_loose")).select(*columns, "sequence_id", "offset"))
        if groups == 1:
            break
        left = packed.filter("_loose").select(*columns, "_row")
        count, level = left.count(), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return out


def _packed(capacity: int, level: int, last: bool, names: list[str]):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, [(c, "ascending") for c in ("length", "doc_id", "piece", "_row") if c in rows.column_names]))
        lengths = rows.column("length").to_numpy().astype(np.int64)
        bins = improve(best_fit(lengths, capacity), lengths, capacity)
        sequence, offset, loose = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64), np.zeros(len(rows), bool)
        for n, items in enumerate(bins):
            sequence[items] = (level << 56) + (key[0].as_py() << 24) + n
            offset[items] = np.cumsum(lengths[items]) - lengths[items]
            loose[items] = not last and 2 * int(lengths[items].sum()) <= capacity
        return rows.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset)).append_column("_loose", pa.array(loose)).select(names)

    return run

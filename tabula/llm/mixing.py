"""Mixing sources to target weights by cube-method balanced sampling.

Every source gets a target number of words.  Its documents are all taken
``floor(target / source size)`` times, and once more with the remaining
fraction as inclusion probability.  Those probabilities move through the null
space of the balancing constraints (words and documents of the source) until
each is 0 or 1: the *flight* runs in blocks of bounded size, so a source of
any size is spread over tasks; what stays undecided in a block, two documents
at most, flies again with the leftovers of other blocks, and the last dozen
of a source are *landed* on the choice nearest to its target.

Ids never leave Arrow, so they come back as they were, nulls beside them or not.

Defined results: a null text has size 0; a null source is a source of its own
and comes last; sources without words get target 0; null ``doc_id`` values
and repeated rows are documents of their own (rows without id are dealt into
blocks by their places in the written unit table); an empty table gives no
rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import count_words, slices, unit_hash, write_scratch

BLOCK = 5000
#: Units of a source that are kept for the landing, besides the two that the flight leaves.
LANDED = 10
_TINY = 1e-9


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size): words of every whole text."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("source"), pa.array(count_words(part.column("text")))], ["doc_id", "source", "size"])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(measure, f"doc_id {kind}, source string, size long")


def targets(units: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """One row per source: its documents, size and target.

    Sources by code point (null last) weigh ``weights`` in turn.  Targets are
    ``min(most * size, level * weight)``; the level solves "targets add up to
    share * all sizes", which is where resharing the excess by weight ends.
    Sorted by ``most * size / weight``, the sources up to some place stop at
    their cap, so the level follows from running sums over the source table.
    """
    by_source = units.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int"))
    capped = by_source.withColumn("weight", turn).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # the level if exactly the sources before this one stop at their caps
    total = F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy())
    level = F.greatest(F.lit(0.0), (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    tried = capped.withColumn("level", level).withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
    # past the first source that fits, the level can only fall
    found = F.max(F.when(F.col("fits"), F.col("level"))).over(Window.partitionBy())
    return tried.withColumn("target", F.least(F.col("cap"), F.coalesce(found * F.col("weight"), F.col("cap")))).select("source", "n_docs", "source_size", "target")


def fly(sizes: Sequence[float], chances: Sequence[float], draws: np.ndarray) -> np.ndarray:
    """Flight phase for the constraints "words" and "documents".

    Three undecided units at a time have a one-dimensional null space, the
    cross product of the two constraint rows; moving along it to the wall
    decides one of them at least and changes neither total.
    """
    out = np.array(chances, float)
    alive: list[int] = []
    for unit in np.flatnonzero((out > _TINY) & (out < 1 - _TINY)).tolist():
        alive.append(unit)
        if len(alive) < 3:
            continue
        a, b, c = alive
        u = (sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b])
        if u == (0, 0, 0):
            u = (1.0, -1.0, 0.0)
        _move(out, alive, u, draws[unit])
        alive = [k for k in alive if _TINY < out[k] < 1 - _TINY]
    return out


def _move(out: np.ndarray, units: list[int], u: Sequence[float], draw: float) -> None:
    """Go along ``u`` or against it as far as all stay in [0, 1], with the chances that keep the expectation."""
    ahead = back = math.inf
    for k, d in zip(units, u, strict=True):
        if d:
            up, down = (1 - out[k]) / abs(d), out[k] / abs(d)
            ahead, back = min(ahead, up if d > 0 else down), min(back, down if d > 0 else up)
    step = ahead if draw * (ahead + back) < back else -back
    for k, d in zip(units, u, strict=True):
        out[k] = min(1.0, max(0.0, out[k] + step * d))
        if out[k] <= _TINY or out[k] >= 1 - _TINY:
            out[k] = round(out[k])


def land(sizes: np.ndarray, chances: np.ndarray, short: float) -> np.ndarray:
    """Decide the last few units: the choice whose words come nearest to ``short``, then whose count comes nearest."""
    open_ = np.flatnonzero((chances > _TINY) & (chances < 1 - _TINY))
    choices = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_)) & 1).astype(float)
    miss = np.abs(choices @ sizes[open_] - short)
    out = chances.round()
    out[open_] = choices[np.lexsort((np.abs(choices.sum(1) - chances[open_].sum()), miss))[0]]
    return out


def _reserve(order: np.ndarray) -> np.ndarray:
    """Units of a source, out of those sorted by falling size, that skip the flight to be landed."""
    small = order[len(order) // 2:]
    return small[np.unique(np.linspace(0, len(small) - 1, min(LANDED, len(small))).astype(int))] if len(order) > 3 else order[:0]


def mix(units: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
        seed: int = 42, block: int = BLOCK) -> DataFrame:
    """Decide how often each unit is taken.

    ``units``: (doc_id, source, size).  Returns them with ``source_size``,
    ``target``, ``copies`` and ``taken`` = size * copies.  The draw depends on
    seed and rows only, so reruns agree.
    """
    block = max(block, 12)  # smaller ones would leave as many open units as they get
    units = units.select("doc_id", "source", "size", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).alias("row"))
    units = write_scratch(units, "mix-units")
    per_source = write_scratch(targets(units, weights, share, most), "mix-targets")
    largest = per_source.agg(F.max("n_docs")).first()[0] or 0
    # no broadcast hint: Spark compares the measured size of the source table with its threshold
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    key = per_source.withColumnRenamed("source", "source_")
    left = (units.join(key, units["source"].eqNullSafe(key["source_"])).drop("source_")
            .withColumn("base", F.floor(ratio).cast("long")).withColumn("chance", ratio - F.floor(ratio)))
    columns = ["doc_id", "row", "source", "size", "n_docs", "source_size", "target", "base", "chance"]
    schema = left.select(*columns).schema
    done: list[DataFrame] = []
    expected, level = largest, 0
    while True:
        last = expected <= block
        blocks = F.ceil(F.col("n_docs") / F.lit((block / 3) ** level * block)) if not last else F.lit(1)
        dealt = left.select(*columns, F.pmod(unit_hash("doc_id", "row", "size", seed=seed + level), blocks).alias("block"))
        flown = dealt.groupBy("source", "block").applyInArrow(_flight(seed + level, last, columns), schema)
        flown = write_scratch(flown, f"mix-level{level}")
        open_ = (F.col("chance") > 0) & (F.col("chance") < 1)
        done.append(flown.filter(~open_))
        if last:
            break
        left = flown.filter(open_)
        expected, level = math.ceil(expected / block) * 3, level + 1
    decided = done[0]
    for more in done[1:]:
        decided = decided.unionAll(more)
    copies = (F.col("base") + F.col("chance")).cast("long")
    return decided.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                          (copies * F.col("size")).alias("taken"))


def _flight(seed: int, last: bool, columns: list[str]):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        source, number = (k.as_py() for k in key)
        rows = rows.take(pc.sort_indices(rows, [("size", "descending"), ("doc_id", "ascending"), ("row", "ascending")]))
        name = b"" if source is None else b"s" + str(source).encode()
        draws = np.random.default_rng([seed, zlib.crc32(name), int(number)]).random(len(rows))
        chances, sizes = (rows.column(c).to_numpy().astype(float) for c in ("chance", "size"))
        kept = _reserve(np.flatnonzero((chances > _TINY) & (chances < 1 - _TINY))) if last else []
        aloft = chances.copy()
        aloft[kept] = 0.0
        flown = fly(sizes.tolist(), aloft, draws)
        flown[kept] = chances[kept]
        if last:
            # the constraints hold so far: the open units owe what is missing of what all chances promise
            decided = np.where((flown > _TINY) & (flown < 1 - _TINY), 0.0, flown)
            flown = land(sizes, flown, float(np.dot(sizes, chances) - np.dot(sizes, decided)))
        flown[flown <= _TINY], flown[flown >= 1 - _TINY] = 0.0, 1.0
        return rows.set_column(rows.schema.get_field_index("chance"), "chance", pa.array(flown)).select(columns)

    return run

"""Near-duplicate vectors by an exact metric range join.

Vectors with equal labels link when their cosine reaches a bound, that is,
when their distance on the unit sphere stays within a radius.  Pivots split a
large label into cells: a vector's home is the cell of its nearest pivot, and
it is copied to every other cell that the triangle inequality leaves within
the radius of the boundary.  Each vector then meets all its partners in its
home cell, so cells join independently and exactly.

* Equal vectors collapse into one weighted row first.
* Vectors within half the radius of their pivot (the cell's core) are all
  linked with each other by the triangle inequality and are counted, not
  compared; a dense ball of any size costs a row each.
* A cell that is larger than a block is joined block by block, in groups of
  bounded size.  Links inside a group come out as one edge per vector to the
  smallest id it reaches there, never as pairs.

Where vectors have no structure (independent directions), the boundary holds
most of a cell's vectors at a radius like 0.2, whatever the pivots: the join
is then as expensive as comparing all pairs of a label.

Defined results: rows whose label, id or vector is null, and vectors that are
zero or hold null or non-finite components, link with nothing and are kept;
vectors of different lengths never link; rows that share an id are one vector
to the components and count as rows in ``n_links``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from .common import unit_hash, write_scratch
from .components import components

CELL = 4000
BLOCK = 3000
MAX_PIVOTS = 32
SAMPLE = 512
#: A sampled vector with this share of the sample within half the radius is the centre of a dense ball.
DENSE = 0.01
_SAFE = 1e-7


def _matrix(column: pa.Array | pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Rows of a list column as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1 if width is None and len(column) else width or 0)


def _normed(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def choose_pivots(sample: np.ndarray, wanted: int, radius: float) -> np.ndarray:
    """Places of the pivots: centres of dense balls first, then others that keep apart from them."""
    cosine = np.clip(sample @ sample.T, -1, 1)
    near = (cosine >= math.cos(radius / 2)).sum(1)
    free = np.ones(len(sample), bool)
    chosen: list[int] = []
    for place in np.argsort(-near, kind="stable").tolist():
        if len(chosen) >= MAX_PIVOTS:
            break
        if free[place] and (near[place] > max(1, DENSE * len(sample)) or len(chosen) < wanted):
            chosen.append(place)
            free &= cosine[place] < math.cos(2 * radius)
    return np.array(chosen, np.int64)


def _usable(vectors: DataFrame) -> DataFrame:
    """Rows that can link, equal ones collapsed: vec_id (smallest), label, embedding, width, mult."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = vectors.filter("vec_id is not null and label is not null and embedding is not null").filter(~bad & F.exists("embedding", lambda x: x != 0))
    return fine.groupBy("label", "embedding").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("mult")).withColumn("width", F.size("embedding"))


def _pivot_table(rows: DataFrame, radius: float) -> DataFrame:
    """label, width, pivots: for labels larger than a cell."""
    large = rows.groupBy("label", "width").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CELL)
    order = Window.partitionBy("label", "width").orderBy(unit_hash("vec_id"), "vec_id")
    sample = (rows.select("label", "width", "vec_id").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= SAMPLE)
              .join(large, ["label", "width"]).select("vec_id", "n"))
    drawn = rows.join(sample, "vec_id").select("label", "width", "n", "vec_id", "embedding")
    schema = StructType([rows.schema["label"], rows.schema["width"], StructField("pivot", IntegerType()), rows.schema["embedding"]])

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("vec_id").combine_chunks()
        wanted = 1 + group.column("n")[0].as_py() // CELL
        places = choose_pivots(_normed(_matrix(group.column("embedding"))), wanted, radius)
        part = group.take(pa.array(places))
        return pa.table([part.column("label"), part.column("width"), pa.array(np.arange(len(places), dtype=np.int32)), part.column("embedding")], names=schema.names)

    pivots = drawn.groupBy("label", "width").applyInArrow(run, schema)
    listed = F.array_sort(F.collect_list(F.struct("pivot", "embedding")))
    return pivots.groupBy("label", "width").agg(F.transform(listed, lambda p: p["embedding"]).alias("pivots"))


def _assigned(rows: DataFrame, radius: float) -> DataFrame:
    """Rows in their home cells and in the cells whose boundary they are near."""
    with_pivots = rows.join(_pivot_table(rows, radius), ["label", "width"], "left").select("label", "width", "vec_id", "mult", "embedding", "pivots")
    schema = StructType([*(rows.schema[c] for c in ("label", "width", "vec_id", "mult", "embedding")), StructField("cell", IntegerType()), StructField("home", BooleanType()), StructField("core", BooleanType())])
    reach = 2 * math.sin(radius / 2) + _SAFE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row_of, cell, home, core = [], [], [], []
            pivots_of: dict = {}
            keys = list(zip(batch.column("label").to_pylist(), batch.column("width").to_pylist(), strict=True))
            for row, key in enumerate(keys):
                pivots_of.setdefault(key, []).append(row)
            for places in pivots_of.values():
                places = np.array(places)
                raw = batch.column("pivots")[int(places[0])].as_py()
                if not raw:
                    row_of.append(places)
                    cell.append(np.zeros(len(places), np.int32))
                    home.append(np.ones(len(places), bool))
                    core.append(np.zeros(len(places), bool))
                    continue
                pivots = _normed(np.array(raw, float))
                own = _normed(_matrix(batch.column("embedding").take(pa.array(places))))
                cosine = own @ pivots.T
                nearest = cosine.argmax(1)
                best = cosine[np.arange(len(own)), nearest]
                apart = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 1e-12))[nearest]
                # distance to the plane between the home pivot and each other one
                stays = (best[:, None] - cosine) / apart <= reach
                stays[np.arange(len(own)), nearest] = True
                r, c = np.nonzero(stays)
                at_home = c == nearest[r]
                row_of.append(places[r])
                cell.append(c.astype(np.int32))
                home.append(at_home)
                core.append(at_home & (best[r] >= math.cos(radius / 2 - _SAFE)))
            if row_of:
                taken = batch.take(pa.array(np.concatenate(row_of)))
                yield pa.RecordBatch.from_arrays([*(taken.column(c) for c in schema.names[:5]), pa.array(np.concatenate(cell)), pa.array(np.concatenate(home)), pa.array(np.concatenate(core))], schema.names)

    return with_pivots.mapInArrow(run, schema)


def _blocks(assigned: DataFrame) -> DataFrame:
    """Every row once for each group of (query block, target block) that needs it.

    Queries are home rows, targets all rows of the cell; core rows have blocks
    of their own, and core meets core nowhere.
    """
    cell = ["label", "width", "cell"]

    def blocks_of(condition) -> Column:
        return F.ceil(F.count(F.when(condition, 1)) / BLOCK).cast("int")

    sizes = assigned.groupBy(*cell).agg(
        blocks_of(F.col("home") & ~F.col("core")).alias("q_rest"), blocks_of(F.col("core")).alias("core_blocks"), blocks_of(~F.col("core")).alias("t_rest"))
    placed = assigned.join(sizes, cell)
    turn = F.abs(unit_hash("vec_id", seed=7) % 1_000_003)
    core, home = F.col("core"), F.col("home")
    q = F.when(core, F.col("q_rest") + turn % F.greatest("core_blocks", F.lit(1))).when(home, turn % F.greatest("q_rest", F.lit(1)))
    t = F.when(core, F.col("t_rest") + turn % F.greatest("core_blocks", F.lit(1))).otherwise(turn % F.greatest("t_rest", F.lit(1)))
    placed = placed.withColumn("q", q.cast("int")).withColumn("t", t.cast("int"))
    all_q, all_t = F.col("q_rest") + F.col("core_blocks"), F.col("t_rest") + F.col("core_blocks")

    def upto(n) -> Column:
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    as_q = F.when(F.col("q").isNotNull(), F.transform(upto(F.when(core, F.col("t_rest")).otherwise(all_t)), lambda j: F.struct(F.col("q").alias("i"), j.alias("j"), F.lit(True).alias("is_q"), (j == F.col("t")).alias("is_t"))))
    as_t = F.transform(upto(F.when(core, F.col("q_rest")).otherwise(all_q)), lambda i: F.struct(i.alias("i"), F.col("t").alias("j"), F.lit(False).alias("is_q"), F.lit(True).alias("is_t")))
    # where a row is both, one copy carries both roles
    others = F.filter(as_t, lambda x: F.col("q").isNull() | (x["i"] != F.col("q")))
    empty = F.expr("cast(array() as array<struct<i:int,j:int,is_q:boolean,is_t:boolean>>)")
    dealt = placed.withColumn("g", F.explode(F.concat(F.coalesce(as_q, empty), others)))
    return dealt.select(*cell, "g.*", "vec_id", "mult", "embedding")


def _compare(bound: float, schema: StructType):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("vec_id").combine_chunks()
        ids, mult = group.column("vec_id").to_numpy(), group.column("mult").to_numpy()
        is_q, is_t = (group.column(c).to_numpy() for c in ("is_q", "is_t"))
        unit = _normed(_matrix(group.column("embedding")))
        q, t = np.flatnonzero(is_q), np.flatnonzero(is_t)
        label = np.arange(len(ids))
        links = np.zeros(len(ids), np.int64)
        rows, cols = [], []
        for at in range(0, len(q), 512):
            some = q[at: at + 512]
            hit = unit[some] @ unit[t].T >= bound
            hit &= some[:, None] != t
            links[some] = hit @ mult[t]
            r, c = np.nonzero(hit)
            # one link a vector and its first partner, then the label they settle on
            rows.append(some[r].astype(np.int32))
            cols.append(t[c].astype(np.int32))
        a, b = np.concatenate([*rows, np.zeros(0, np.int32)]), np.concatenate([*cols, np.zeros(0, np.int32)])
        while len(a):
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            label = label[label]
            open_ = label[a] != label[b]
            if not open_.any():
                break
        linked = np.unique(np.concatenate([a, b])).astype(np.int64)
        return pa.table([pa.array(ids[linked]), pa.array(links[linked]), pa.array(ids[label[linked]])], schema=pa.schema([("vec_id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())]))

    return run


def range_join(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, label, embedding)."""
    radius = math.acos(cosine)
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    rows = write_scratch(_usable(vectors), "range-rows")
    assigned = write_scratch(_assigned(rows, radius), "range-cells")
    schema = StructType([StructField("vec_id", LongType()), StructField("links", LongType()), StructField("root", LongType())])
    compared = _blocks(assigned).groupBy("label", "width", "cell", "i", "j").applyInArrow(_compare(cosine, schema), schema)
    core = assigned.filter("core")
    ball = core.groupBy("label", "width", "cell").agg(F.sum("mult").alias("all"), F.min("vec_id").alias("root"))
    inside = core.join(ball, ["label", "width", "cell"]).select("vec_id", (F.col("all") - F.col("mult")).alias("links"), "root")
    found = write_scratch(compared.unionAll(inside), "range-links")
    reached = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    direct = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    classes = (rows.select("vec_id", "label", "embedding", "mult").join(direct, "vec_id", "left")
               .join(reached, F.col("vec_id") == F.col("node"), "left")
               .select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")))
    known = F.col("vec_id").isNotNull()  # a row without id may equal a vector that links
    links = F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long")
    out = vectors.join(classes, ["label", "embedding"], "left").select("vec_id", links.alias("n_links"), F.when(known, F.coalesce("component_id", "vec_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

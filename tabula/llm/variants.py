"""Grouping spelling variants: words one edit apart, each drawn to its most frequent neighbour.

Two words are near if one inserted, deleted or replaced code point makes them
equal.  Near words are found in sorted lists by dynamic programming.  The
matrix of edits between a query and a list word has one row per code point of
the list word and, for one edit, three cells a row (the band).  Neighbours in
a sorted list share rows up to their longest common prefix (LCP), so a row is
computed once for the whole range of words that share the prefix, and the
range is skipped as soon as all of the row exceeds one edit.  ``scan`` goes
down the prefixes, all queries and ranges of a batch at a time.

The vocabulary is parted so that every pair meets in exactly one list.  The
first place ``j`` in which two words differ lies in some interval ``[lo, hi)``;
words that differ there share ``lo`` code points in front and those after the
interval at the end.  So a list is the words of one *class* (the length of the
shorter word), interval, shared front and shared end.  It starts with halves;
a list of more than ``LIST`` words is halved again, and again, until the
interval is one place, where a list has at most one word per letter and
length.  Lists of any vocabulary are bounded that way, without a cap, and a
pair comes out once, so nothing has to be made distinct.

Defined results: null texts and texts without a word give nothing, nor do null
or empty words; copies and repeated rows count as often as they appear; ties
go to the smaller word; an empty table gives no rows.  A null id is the empty
text where runs slip.  Extra columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_scratch

#: Words of a list beyond which it is parted by a shorter interval.
LIST = 4096
#: Letters of a run.
LETTERS = r"[A-Za-zÀ-ÿ]"

_KEY = ["cls", "lo", "hi", "front", "back"]
_FIELDS = "cls int, lo int, hi int, front string, back string, word string, n long"


def vocabulary(docs: DataFrame, slip: int = 199, least_length: int = 6, least_count: int = 5,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters of every whole text, A-Z in lower case, by their number.

    Where ``slip`` divides ``h``, the CRC-32 of ``<doc_id>:<run>``, the run
    loses the code point ``h % length``: a known share of misspellings.
    """
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))
    taken = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    run = F.col("run")
    # lower() is A-Z alone where all is ASCII
    folded = F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, string.ascii_uppercase, string.ascii_lowercase))
    hashed = taken.select("id", folded.alias("run")).withColumn("h", F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8")))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % slip == 0, slipped).otherwise(F.col("run")).alias("word")
    counted = hashed.select(word).filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least_count)


def _halves(lo, hi):
    middle = F.floor((lo + hi) / 2).cast("int")
    return F.array(F.struct(lo.alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), hi.alias("hi")))


def _placed(rows: DataFrame) -> DataFrame:
    """Add the shared front and end to (cls, lo, hi, word, n)."""
    back = F.greatest(F.col("cls") - F.col("hi"), F.lit(0))
    front = F.substring(F.col("word"), F.lit(1), F.col("lo"))
    end = F.substring(F.col("word"), F.length("word") - back + 1, back)
    return rows.select("cls", "lo", "hi", front.alias("front"), end.alias("back"), "word", "n")


def lists(words: DataFrame, limit: int = LIST) -> DataFrame:
    """(cls, lo, hi, front, back, word, n): the lists in which words meet, none above ``limit`` unless its interval is one place."""
    length = F.length("word").cast("int")
    classes = F.filter(F.array(length, length - 1), lambda c: c >= 1)
    halves = _halves(F.lit(0), F.col("cls") + 1)
    rows = words.select("word", "n", F.explode(classes).alias("cls")).select("word", "n", "cls", F.explode(halves).alias("x"))
    rows = write_scratch(_placed(rows.select("cls", "x.lo", "x.hi", "word", "n")), "variant-lists")
    done: list[DataFrame] = []
    while True:
        large = write_scratch(rows.filter("hi - lo > 1").groupBy(_KEY).count().filter(F.col("count") > limit).drop("count"), "variant-large")
        if large.isEmpty():
            break
        done.append(rows.join(large, _KEY, "left_anti"))
        again = rows.join(large, _KEY, "left_semi").select("cls", F.explode(_halves(F.col("lo"), F.col("hi"))).alias("x"), "word", "n")
        rows = write_scratch(_placed(again.select("cls", "x.lo", "x.hi", "word", "n")), "variant-lists")
    for more in done:
        rows = rows.unionAll(more)
    return rows


def _lcp(points: np.ndarray, start: np.ndarray, length: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common prefix of words ``a`` and ``b``, pairwise."""
    common = np.minimum(length[a], length[b])
    at = np.cumsum(common) - common
    place = np.arange(int(common.sum())) - np.repeat(at, common)
    same = points[np.repeat(start[a], common) + place] == points[np.repeat(start[b], common) + place]
    ends = np.where(same, np.repeat(common, common), place)
    out = np.zeros(len(a), np.int64)
    some = common > 0
    if some.any():
        out[some] = np.minimum.reduceat(ends, at[some])
    return out


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of ``first[i] .. last[i] - 1`` for all i end to end, and the i of each."""
    size = last - first
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + first[of], of


def scan(words: list[str], group: np.ndarray, cls: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Near words within sorted lists: (query, found) places in ``words``.

    ``group`` numbers the lists, whose words are adjacent, distinct and in
    order; ``cls``, ``lo`` and ``hi`` are those of the list, per word.  Queries
    are the words of the class's length; pairs with a longer word come out from
    their shorter side, pairs of equal length from both.
    """
    none = np.zeros(0, np.int64)
    if not len(words):
        return none, none
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    length = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(length) - length
    every = np.arange(len(words))
    lcp = np.full(len(words), -1)
    inner = every[1:][group[1:] == group[:-1]]
    lcp[inner] = _lcp(points, start, length, inner - 1, inner)
    head = np.maximum.accumulate(np.where(lcp < 0, every, 0))
    queries = every[length == cls]
    pad = np.append(points, 0)

    def letter(of: np.ndarray, place: np.ndarray) -> np.ndarray:
        return pad[np.minimum(start[of] + np.maximum(place, 0), len(points))]

    depth = int(lo[queries].min()) if len(queries) else 0
    last_start = int(lo[queries].max()) if len(queries) else -1
    q, node = none, none
    o0 = o1 = o2 = np.zeros(0, np.int8)
    deep = every[length >= depth]
    out_q, out_w = [none], [none]
    while depth <= last_start or len(q):
        enter = queries[lo[queries] == depth]
        if len(enter):  # the shared front is equal: the row of no edits
            far = np.full(len(enter), 2, np.int8)
            q, node = np.append(q, enter), np.append(node, head[enter])
            o0 = np.append(o0, far - 1 if depth else far)
            o1 = np.append(o1, far - 2)
            o2 = np.append(o2, np.where(length[enter] > depth, 1, 2).astype(np.int8))
        # ranges of words that share depth + 1 letters, within those that share depth
        parents = deep[lcp[deep] < depth]
        deep = deep[length[deep] > depth]
        children = deep[lcp[deep] <= depth]
        above = np.searchsorted(parents, children, "right") - 1
        mine = np.searchsorted(parents, node)
        child, of = _ranges(np.searchsorted(above, mine, "left"), np.searchsorted(above, mine, "right"))
        q, o0, o1, o2, node = q[of], o0[of], o1[of], o2[of], children[child]
        x = letter(node, np.full(len(node), depth))
        size = length[q]
        n0 = np.minimum(o0 + (letter(q, np.full(len(q), depth - 1)) != x), o1 + 1)
        n1 = np.minimum(np.minimum(o1 + (letter(q, np.full(len(q), depth)) != x), o2 + 1), n0 + 1)
        n1[depth + 1 > size] = 2
        n2 = np.minimum(o2 + (letter(q, np.full(len(q), depth + 1)) != x), n1 + 1)
        n2[depth + 2 > size] = 2
        depth += 1
        # the first word of a range may end here; it is the only one, as words are distinct
        ends = (length[node] == depth) & (np.where(size == depth, n1, np.where(size == depth - 1, n0, 2)) == 1)
        out_q.append(q[ends])
        out_w.append(node[ends])
        alive = np.minimum(np.minimum(n0, n1), n2) <= 1
        q, node, o0, o1, o2 = q[alive], node[alive], *(np.minimum(n[alive], 2).astype(np.int8) for n in (n0, n1, n2))
    found_q, found_w = np.concatenate(out_q), np.concatenate(out_w)
    here = _lcp(points, start, length, found_q, found_w) < hi[found_q]
    return found_q[here], found_w[here]


def near_pairs(placed: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of near words, out of ``lists``."""
    ordered = placed.repartition(*_KEY).sortWithinPartitions(*_KEY, "word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            new = _changes(table)
            last = int(new[-1]) if len(new) else 0  # the last list may go on in the next batch
            held = table.slice(last).combine_chunks()
            if last:
                yield _found(table.slice(0, last))
        if held is not None and len(held):
            yield _found(held)

    return ordered.mapInArrow(run, "word string, n long, near string, near_n long")


def _changes(table: pa.Table) -> np.ndarray:
    """Rows at which a list begins, but for the first."""
    differs = np.zeros(max(len(table) - 1, 0), bool)
    for name in _KEY:
        column = table.column(name).to_numpy()
        differs |= column[1:] != column[:-1]
    return np.flatnonzero(differs) + 1


def _found(table: pa.Table) -> pa.RecordBatch:
    starts = np.zeros(len(table), np.int64)
    starts[_changes(table)] = 1
    cls, lo, hi = (table.column(c).to_numpy().astype(np.int64) for c in ("cls", "lo", "hi"))
    word, n = table.column("word").combine_chunks(), table.column("n").combine_chunks()
    q, w = scan(word.to_pylist(), np.cumsum(starts), cls, lo, hi)
    size = np.fromiter(map(len, word.to_pylist()), np.int64, len(word))
    back = size[w] > size[q]  # longer words are no queries
    a, b = pa.array(np.append(q, w[back])), pa.array(np.append(w, q[back]))
    return pa.RecordBatch.from_arrays([word.take(a), n.take(a), word.take(b), n.take(b)], ["word", "n", "near", "near_n"])


def group(words: DataFrame, ratio: int = 5, limit: int = LIST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n) rows; repeated words add up.

    ``form`` is the near word of largest n (ties: the smallest) if its n is at
    least ``ratio`` times the word's, else null; ``root`` follows forms to the
    last.  A form is always more frequent, so every chain ends, after some
    log(largest n) / log(ratio) steps.
    """
    known = words.filter(F.length("word") > 0).groupBy("word").agg(F.sum("n").alias("n"))
    words = write_scratch(known, "variant-words")
    pairs = near_pairs(lists(words, limit))
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")
    found = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    near = words.join(found, "word", "left")
    drawn = -F.col("best.n") >= ratio * F.col("n")
    near = write_scratch(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                     F.when(drawn, F.col("best.word")).alias("form"), F.when(drawn, -F.col("best.n")).alias("form_n")), "variant-forms")
    roots = _roots(near.filter("form is not null").select("word", F.col("form").alias("root")))
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """Follow (word, root) links to the last, twice as far each round."""
    links = write_scratch(links, "variant-roots")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = write_scratch(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        if stepped.filter("moved").isEmpty():
            return stepped.select("word", "root")
        links = stepped.select("word", "root")

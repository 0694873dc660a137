"""Secret scan: fixed patterns plus character Markov models, in DataFrame functions only.

Three patterns find assignments, access keys and long hexadecimal runs.  Two
first-order character models, one of random strings and one of ordinary
identifiers, add what the patterns miss: a run of 20 or more key characters
outside their spans is a secret if its log-likelihood ratio per transition
exceeds a margin.  Shorter runs are not judged.

The random model counts the transitions of digests, whole, in base64, in upper
case and in letters alone.  Documents carry no labels, so the ordinary model
must not take the secrets in them for ordinary text.  It is fitted twice: first
on the runs too short to be judged and on identifiers made of the documents'
words with digits and separators; then also on those longer runs, of all
documents, that the first fit does not call random.  Chances are smoothed by a
share of the count, so the ratio does not drift with the number of documents.
A fifth of the distinct identifiers and digests is kept aside and places the
margin.  A model is a table over the alphabet, so its size is fixed.

Work grows in proportion to a text and its matches: places are running sums
over groups of ``GROUP`` matches, then over the groups, and a text is rebuilt
from the pieces between spans, cut out of blocks of ``BLOCK`` characters.

Defined results: null and empty texts have no spans; equal rows get equal
results; spans count code points, end exclusive; an empty table gives no
rows; without ordinary samples the models add nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unit_hash, write_scratch

#: Names that announce a value, and the patterns of the three kinds.
NAMES = ["password", "passwd", "secret", "token"]


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" for c in word)


ASSIGN = ("(" + "|".join([*map(_either_case, NAMES), _either_case("api") + "_?" + _either_case("key")]) + ")"
          r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: A run that is long enough starts where its first AKIA starts, so the length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KEYLIKE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
#: All that the three patterns take; an assigned value under six characters is no secret.
COVERED = f"{ASSIGN[:-2]}{{6,}})|{ACCESS}|{HEX}"
RUN = r"[A-Za-z0-9+/_-]{2,}"
KINDS = ["assign", "access", "hex", "markov"]

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
_SIDE = len(ALPHABET) + 1  # place 0: any other character

#: Length from which runs are judged.
LEAST = 20
GROUP, BLOCK = 128, 1024
RANDOM_STRINGS = 1500
MARGIN = 0.4
#: Share of a row's chances that all transitions have alike, and the least count for it.
FLOOR = 0.02
ASIDE = 5
_BUCKETS = 50


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it stands in there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _grouped(items: Column) -> Column:
    """The items in arrays of ``GROUP``."""
    last = F.floor((F.size(items) - 1) / GROUP).cast("int")
    return F.when(F.size(items) > 0, F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(items, k * GROUP + 1, GROUP))).otherwise(F.array_repeat(items, 0))


def _running(items: Column, kind: str, step, emit) -> Column:
    """One value an item, from an integer state that runs over all items: ``step(state, item)`` is
    the next state, ``emit(state, item)`` the value, ``kind`` the values' type.

    ``step`` must add to the state or take the greater of it and something, so
    that a group's own end state, from zero, and the state before it make the
    state after it, by the same operation.
    """
    none = F.expr(f"cast(array() as array<{kind}>)")
    starts = F.expr("cast(array(0) as array<int>)")

    def after(state: Column, group: Column) -> Column:
        own = F.aggregate(group, F.element_at(state, -1), step)
        return F.concat(state, F.array(own))

    def walk(group: Column, start: Column) -> Column:
        zero = F.struct(start.alias("at"), none.alias("out"))
        return F.aggregate(group, zero, lambda s, x: F.struct(step(s["at"], x).alias("at"), F.concat(s["out"], F.array(emit(s["at"], x))).alias("out")), lambda s: s["out"])

    def whole(groups: Column) -> Column:
        return F.flatten(F.zip_with(groups, F.slice(F.aggregate(groups, starts, after), 1, F.size(groups)), walk))

    return _once(_once(items, _grouped), whole)


def _found(text: Column, pattern: str, kind: str) -> Column:
    """Leftmost non-overlapping matches as an array of (start, rank, end, kind, hit).

    The text split at the matches gives what lies between them, and running
    sums of lengths give the places.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(between, 1, F.size(hits)), hits, lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")))
    span = "struct<start:int,rank:int,end:int,kind:string,hit:string>"

    def place(at: Column, pair: Column) -> Column:
        start = at + pair["gap"]
        return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (start + F.length(pair["hit"])).alias("end"), F.lit(kind).alias("kind"), pair["hit"].alias("hit"))

    walked = _running(pairs, span, lambda at, pair: at + pair["gap"] + F.length(pair["hit"]), place)
    return F.when(text.rlike(pattern), walked).otherwise(F.expr(f"cast(array() as array<{span}>)"))


def replaced(text: Column, spans: Column, mark) -> Column:
    """The text with what the spans cover replaced: ``mark(length)`` stands for the part of a span,
    of that length, that no earlier one covers.  ``spans`` are in the order of their starts."""
    def cut(blocks: Column, a: Column, b: Column) -> Column:
        """Characters ``a`` to ``b`` of a text given in blocks."""
        first, last = F.floor(a / BLOCK).cast("int"), F.floor((b - 1) / BLOCK).cast("int")
        here = F.substring(F.get(blocks, first), a - first * BLOCK + 1, b - a)
        inner = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        apart = F.concat(F.substring(F.get(blocks, first), a - first * BLOCK + 1, F.lit(BLOCK)), inner, F.substring(F.get(blocks, last), F.lit(1), b - last * BLOCK))
        return F.when(b <= a, F.lit("")).when(first == last, here).otherwise(apart)

    kind = "struct<at:int,start:int,end:int>"
    marked = _running(spans, kind, lambda at, s: F.greatest(at, s["end"]), lambda at, s: F.struct(at.alias("at"), s["start"].alias("start"), s["end"].alias("end")))

    def build(held: Column) -> Column:
        blocks = held["blocks"]
        pieces = F.transform(held["marked"], lambda s: F.when(s["end"] <= s["at"], F.lit("")).otherwise(
            F.concat(cut(blocks, s["at"], s["start"]), mark(s["end"] - F.greatest(s["at"], s["start"]), s["start"] >= s["at"]))))
        end = F.array_max(F.transform(held["marked"], lambda s: s["end"]))
        return F.concat(F.array_join(pieces, ""), cut(blocks, end, held["size"]))

    held = F.struct(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)).alias("blocks"), marked.alias("marked"), F.length(text).alias("size"))
    return F.when(F.size(spans) > 0, _once(held, build)).otherwise(text)


def ordinary_runs(docs: DataFrame) -> DataFrame:
    """(text, n): the distinct runs of key characters in all documents that no pattern covers, and how often each is there."""
    runs = F.regexp_extract_all(F.regexp_replace("text", COVERED, " "), F.lit(RUN), F.lit(0))
    return docs.select(F.explode(runs).alias("text")).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


def _made(word: Column) -> Column:
    """An identifier as names, versions, dates and paths are made of a word; the word's hash picks the form and the digits."""
    digits = F.lpad(F.pmod(unit_hash(word, seed=2), F.lit(10 ** 12)).cast("string"), 12, "0")

    def some(at: int, n: int) -> Column:
        return F.substring(digits, at, n)

    low, high = F.lower(word), F.upper(word)
    forms = [F.concat(low, some(1, 1), F.lit("_"), low, some(2, 1), F.lit("_"), low),
             F.concat(low, F.lit("_v"), some(1, 1), F.lit("_"), low, F.lit("_20"), some(2, 2)),
             F.concat(high, F.lit("_20"), some(1, 6), F.lit("_"), some(7, 6), F.lit("_"), high),
             F.concat(low, F.lit("-20"), some(1, 2), F.lit("-"), some(3, 2), F.lit("-"), some(5, 2), F.lit("-"), low),
             F.concat(F.lit("/"), low, F.lit("/20"), some(1, 2), F.lit("/"), low, F.lit("-"), some(3, 2)),
             F.concat(low, F.initcap(low), some(1, 2), F.initcap(low))]
    return F.element_at(F.array(*forms), (F.pmod(unit_hash(word, seed=3), F.lit(len(forms))) + 1).cast("int"))


def labelled_samples(docs: DataFrame, strings: int = RANDOM_STRINGS) -> DataFrame:
    """(text, n, is_random, judged, aside) training samples.

    Random: digests in hexadecimal, base64, upper-case letters and digits, and
    letters alone.  Ordinary: the runs of all documents, and for each that is a
    word an identifier made of it.  ``judged`` marks the documents' own runs that
    are long enough to be secrets themselves; ``aside`` a fifth of the distinct
    strings of that length.
    """
    spark = docs.sparkSession
    digest = F.sha2(F.concat(F.lit("sample-"), F.col("id").cast("string")), 256)
    code = F.base64(F.unhex(digest))
    random_ = spark.range(strings).select(F.explode(F.array(
        F.substring(digest, 1, 40), F.regexp_replace(code, "=", ""),
        F.regexp_replace(F.upper(code), "[^A-Z0-9]", ""), F.regexp_replace(code, "[^A-Za-z]", ""),
        F.regexp_replace(F.lower(code), "[^a-z]", ""))).alias("text"), F.lit(1).cast("long").alias("n"), F.lit(True).alias("is_random"), F.lit(False).alias("judged"))
    runs = ordinary_runs(docs)
    own = F.struct(F.col("text"), (F.length("text") >= LEAST).alias("judged"))
    made = F.struct(_made(F.col("text")).alias("text"), F.lit(False).alias("judged"))
    forms = F.when(F.col("text").rlike(f"^[A-Za-z]{{3,{LEAST - 1}}}$"), F.array(own, made)).otherwise(F.array(own))
    ordinary = runs.select(F.explode(forms).alias("x"), "n").select("x.text", "n", F.lit(False).alias("is_random"), "x.judged")
    return random_.unionAll(ordinary).withColumn("aside", (F.length("text") >= LEAST) & (F.pmod(unit_hash("text", seed=1), F.lit(ASIDE)) == 0))


def _log_ratio(counts: dict[bool, list[float]], smoothing: float) -> list[float]:
    out = []
    for a in range(_SIDE):
        chances = []
        for kind in (True, False):
            row = counts[kind][a * _SIDE: (a + 1) * _SIDE]
            spread = max(smoothing * _SIDE, FLOOR * sum(row))
            chances.append([(x + spread / _SIDE) / (sum(row) + spread) for x in row])
        out += [math.log(x) - math.log(y) for x, y in zip(*chances, strict=True)]
    return out


def _transitions(samples: DataFrame) -> dict:
    """Counts of the alphabet's transitions by (is_random, aside): fixed numbers, whatever the samples."""
    places = F.transform(F.split(F.col("text"), ""), lambda c: F.instr(F.lit(ALPHABET), c))
    placed = samples.filter(F.length("text") > 1).select("is_random", "aside", "n", places.alias("places"))
    after = F.slice("places", 2, F.size("places") - 1)
    # the last place has no follower, so its pair is null
    steps = F.zip_with("places", after, lambda a, b: a * _SIDE + b)
    counted = (placed.select("is_random", "aside", "n", F.explode(steps).alias("step")).filter("step is not null")
               .groupBy("is_random", "aside", "step").agg(F.sum("n").alias("n")).collect())
    return {(row["is_random"], row["aside"], row["step"]): row["n"] for row in counted}


def _fitted(counted: dict, samples: DataFrame, smoothing: float) -> list[float]:
    kept, whole = ({kind: [0.0] * _SIDE ** 2 for kind in (True, False)} for _ in range(2))
    for (is_random, aside, step), n in counted.items():
        whole[is_random][step] += n
        if not aside:
            kept[is_random][step] += n
    lift = MARGIN - calibrated(samples, _log_ratio(kept, smoothing))
    return [x + lift for x in _log_ratio(whole, smoothing)]


def train(samples: DataFrame, smoothing: float = 1.0) -> list[float] | None:
    """Log ratio of the two models' transition chances, row by row; None without samples of either label.

    Runs that may be secrets (``judged``) teach the ordinary model only where a
    first fit without them calls them ordinary.  Only the counts of the
    alphabet's transitions and histograms, fixed numbers, reach the driver.
    """
    sure = samples.filter("is_random OR NOT judged")
    counted = _transitions(sure)
    if len({is_random for is_random, _, _ in counted}) < 2:
        return None
    first = _fitted(counted, sure, smoothing)
    more = samples.filter("judged AND NOT is_random").filter(ratio(F.col("text"), first) <= MARGIN)
    for key, n in _transitions(more).items():
        counted[key] = counted.get(key, 0) + n
    return _fitted(counted, sure.unionAll(more), smoothing)


def calibrated(samples: DataFrame, model: list[float]) -> float:
    """The ratio that best parts the ordinary and the random strings kept aside: least sum of both
    shares on the wrong side, the middle of equals; the fixed margin without strings of either."""
    bucket = F.floor(ratio(F.col("text"), model) * _BUCKETS).cast("int").alias("bucket")
    judged = samples.filter("aside")
    found = judged.select("is_random", bucket).groupBy("is_random", "bucket").count().collect()
    total = {kind: sum(r["count"] for r in found if r["is_random"] == kind) for kind in (True, False)}
    if not all(total.values()):
        return MARGIN
    low, high = min(r["bucket"] for r in found), max(r["bucket"] for r in found)
    wrong = {at: sum(r["count"] / total[r["is_random"]] for r in found if (r["bucket"] < at) == r["is_random"]) for at in range(low, high + 2)}
    least = [at for at, x in wrong.items() if x <= min(wrong.values()) + 1e-9]
    return (least[0] + least[-1]) / 2 / _BUCKETS


def ratio(string: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio per transition, random against ordinary."""
    weights = F.split(F.lit(",".join(f"{x:.5f}" for x in model)), ",").cast("array<double>")
    places = F.transform(F.split(string, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def step(state: Column, place: Column) -> Column:
        added = F.when(state["last"] < 0, F.lit(0.0)).otherwise(F.get(weights, state["last"] * _SIDE + place))
        return F.struct(place.alias("last"), (state["sum"] + added).alias("sum"))

    return F.aggregate(places, start, step, lambda state: state["sum"]) / F.greatest(F.size(places) - 1, F.lit(1))


def scan(docs: DataFrame, model: list[float] | None, text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """Add ``base_spans`` and ``spans``: arrays of (start, rank, end, kind, hit), by start, then kind as listed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    assign = F.filter(_found(text, ASSIGN, "assign"), lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 2)) >= 6)
    base = F.array_sort(F.concat(assign, _found(text, ACCESS, "access"), _found(text, HEX, "hex")))
    out = docs.withColumn("base_spans", base)
    if model is None:
        return out.withColumn("spans", F.col("base_spans"))
    # what the patterns cover is blanked out, so what is left of a run is judged by itself
    rest = replaced(text, F.col("base_spans"), lambda length, _: F.repeat(F.lit(" "), length))
    random_ = F.filter(_found(rest, KEYLIKE, "markov"), lambda s: ratio(s["hit"], model) > margin)
    return out.withColumn("spans", F.array_sort(F.concat(F.col("base_spans"), random_)))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones together, replaced by ``mark``."""
    return replaced(text, spans, lambda _, fresh: F.when(fresh, F.lit(mark)).otherwise(F.lit("")))


def model_for(docs: DataFrame) -> list[float] | None:
    return train(write_scratch(labelled_samples(docs), "secret-samples"))


def report(docs: DataFrame, model: list[float] | None) -> DataFrame:
    """The query's columns: counts of the base kinds, digest of the base spans, and all spans."""
    found = scan(docs, model)

    def n(kind: str) -> Column:
        return F.size(F.filter(F.col("base_spans"), lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(listed(F.col("base_spans")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


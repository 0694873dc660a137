r"""Deterministic per-row hash units for sampling, splitting and folds.

``Dataset.sample``/``randomSplit`` draw from a per-partition generator, so the
same seed picks different rows after a repartition.  These helpers make the
draw a pure function of the row key and the seed instead: a projection, no
shuffle, identical on any cluster layout and on re-execution after a lost
executor.

Unit: ``h = first 32 bits of md5("<key>:<seed>")`` as a bigint in [0, 2^32).
A NULL key part counts as the text ``\N``, alone and among several parts alike,
so a row always has a unit and no draw loses it.
A row falls below fraction ``w`` when ``h < round(w * 2^32)``.  The same
number is ``('0x' || substr(md5(key || ':' || seed), 1, 8))::BIGINT`` in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = 1 << 32
#: What a NULL key part counts as.
NULL_KEY = r"\N"


def _key_string(keys) -> Column:
    if isinstance(keys, (str, Column)):
        keys = [keys]
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    cols = [F.coalesce(p.cast("string"), F.lit(NULL_KEY)) for p in parts]
    return cols[0] if len(cols) == 1 else F.concat_ws("|", *cols)


def hash_unit(keys, seed: int) -> Column:
    """bigint in [0, 2^32), uniform over keys, fixed for (key, seed)."""
    text = F.concat(_key_string(keys), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def threshold(fraction: float) -> int:
    """Integer cut point for a fraction of the hash space (clamped to [0, 2^32])."""
    return max(0, min(SPACE, int(round(float(fraction) * SPACE))))


def cumulative_thresholds(weights) -> list[int]:
    """Upper cut points for normalised weights; the last one is exactly 2^32."""
    total = float(sum(weights))
    if total <= 0:
        raise ValueError("weights must sum to a positive number")
    cuts, acc = [], 0.0
    for w in weights:
        if w < 0:
            raise ValueError("weights must be non-negative")
        acc += w
        cuts.append(threshold(acc / total))
    cuts[-1] = SPACE
    return cuts


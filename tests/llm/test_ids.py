"""No operator changes or merges ids: values beyond doubles beside nulls, in every operator and stage."""
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import SCHEMA, SF_SMALL, _library, prose  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from tabula.llm import embed_join, importance, langid, minmax, mixing, packing, quality, rules, secret_scan, substring, token_counts, token_files
from tabula.session import scratch_path

IDS = [2**60 + 1, 2**60 + 3, None, -(2**62) - 1, 2**53 + 1, None, 2**63 - 1]


@pytest.fixture(scope="module")
def wide(spark):
    rows = [(d, prose(50 + k, 30 + k), ["en", "fr"][k % 2], "a" if k < 6 else None, 1) for k, d in enumerate(IDS * 6) if k < 7 or d is not None]
    seen, out = set(), []
    for k, (d, *rest) in enumerate(rows):
        d = d if d is None or d not in seen else d - 2 * k - 2
        seen.add(d)
        out.append((d, *rest))
    return spark.createDataFrame(out, SCHEMA).repartition(3)


def _labels(docs):
    return docs.select("doc_id", (F.abs(F.xxhash64("text")) % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))


def _tokens(docs):
    path = scratch_path(docs.sparkSession, "ids-tokens")
    token_files.write_tokens(docs, path, file_bytes=500)
    return token_files.read_tokens(docs.sparkSession, path)


OPERATORS = {
    "op1": lambda d: mixing.mix(mixing.sized(d), block=12),
    "op2": lambda d: secret_scan.report(d, secret_scan.model_for(d)),
    "op3": substring.report,
    "op4": lambda d: rules.judge(d, _labels(d)),
    "op5": _tokens,
    "op7": lambda d: minmax.near_duplicates(d, n=3, percent=85),
    "op8": lambda d: langid.identify(d.select("doc_id", "text"), langid.train(d.select("doc_id", "text", "lang"))),
    "op9": lambda d: quality.score(d, quality.train(d, _labels(d))),
    "op10": lambda d: packing.pack(packing.pieces(d, capacity=512), capacity=512, group=8),
    "op12": lambda d: importance.resample(d, d.limit(3)),
    "op13": lambda d: token_counts.count_tokens(d, scratch_path(d.sparkSession, "ids-cache")),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_ids_come_back(wide, name):
    want = Counter(r["doc_id"] for r in wide.collect())
    assert want[None] == 2
    assert Counter(r["doc_id"] for r in OPERATORS[name](wide).collect()) == want


def test_vector_ids_come_back(spark):
    rng = np.random.default_rng(3)
    rows = [(d, 1, rng.normal(size=4).tolist()) for d in IDS] + [(7, 1, [1.0, 0.0, 0.0, 0.0]), (None, 1, [1.0, 0.0, 0.0, 0.0]), (8, 1, [1.0, 0.0, 0.0, 1e-3])]
    out = embed_join.range_join(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), 0.98).collect()
    assert Counter(r["vec_id"] for r in out) == Counter(r[0] for r in rows)
    assert {(r["n_links"], r["component_id"], r["kept"]) for r in out if r["vec_id"] is None} == {(0, None, True)}
    by_id = {r["vec_id"]: r for r in out}
    assert by_id[7]["component_id"] == by_id[8]["component_id"] == 7 and by_id[7]["n_links"] == 1


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_rows_as_they_are(wide, k):
    name, stage = corpus_pipeline.STAGES[k]
    before = {repr(r) for r in wide.collect()}
    after = [repr(r) for r in stage(wide.sparkSession, wide, SF_SMALL).collect()]
    assert after and set(after) <= before
    if k < 3:
        assert Counter(after) == Counter(repr(r) for r in wide.collect())


def test_mixing_stage_meets_targets_without_ids(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")))
    out = corpus_pipeline.mix_sources(spark, docs, SF_SMALL)
    size = F.size(F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)")))
    taken = {r[0]: r[1] for r in out.groupBy("source").agg(F.sum(size)).collect()}
    want = {r["source"]: r["target"] for r in mixing.targets(mixing.sized(docs), (3, 1, 2), 1.5, 2.0).collect()}
    worst = max(abs(taken.get(s, 0) - t) / t for s, t in want.items() if t)
    assert worst < 0.01
    known = Counter(r["doc_id"] for r in out.collect() if r["doc_id"] is not None)
    assert max(known.values()) <= 2 and set(known) <= {r["doc_id"] for r in docs.collect()}


def test_null_ids_spread_over_groups(spark):
    from tabula.llm.common import unit_hash  # noqa: F401 - the deal of both operators

    units = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a").alias("source"), F.lit(7).cast("long").alias("size"))
    got = mixing.mix(units, block=200).collect()
    assert sum(r["taken"] for r in got) == round(got[0]["target"] / 7) * 7 and len(got) == 4000
    pieces = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(30).cast("long").alias("length"))
    rows = packing.pack(pieces, capacity=100, group=500).collect()
    groups = defaultdict(int)
    for r in rows:
        groups[r["sequence_id"] >> 24] += 1
    assert len(groups) >= 8 and max(groups.values()) < 900
    # three to a sequence; the levels leave at most one underfull sequence altogether
    assert len({r["sequence_id"] for r in rows}) == -(-4000 // 3)

"""Corpus pipeline: from raw documents to packed training sequences.

Five stages, each a function of (spark, docs, sf_dir).  ``run`` writes every
stage's rows as Parquet to the folder that all machines share and reads them
back as the next stage's documents, so a lost executor never costs more than
the stage at hand.  All stages but the last return the columns of
``documents``; each works on everything its predecessor kept.

No stage has an SQL form (language filters, min-max signatures, Markov
models, balanced sampling and local search are not SQL), so there is no
oracle text; ``tests/llm`` holds each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.llm import langid, minmax, mixing, packing, secret_scan
from tabula.llm.common import table, without, write_scratch

#: A text whose language knows under this share of its n-grams is not prose in any learned language.
LEAST_KNOWN = 0.2

ORACLE_SQL = None


def _columns(docs: DataFrame) -> list[str]:
    return list(docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: drops documents without a letter and those that no learned language covers.

    The model learns from the documents' own ``lang``; without any learned
    language nothing can be judged and everything stays.  Others keep their
    row as it is; null and empty texts go.
    """
    model = langid.train(docs.select("doc_id", "text", "lang"))
    if not model.langs:
        return docs
    names = {c: f"_in_{n}" for n, c in enumerate(docs.columns) if c in ("lang_pred", "score", "margin")}
    judged = langid.identify(docs.withColumnsRenamed(names), model)
    kept = judged.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_KNOWN))
    return kept.drop("lang_pred", "score", "margin").withColumnsRenamed({v: k for k, v in names.items()}).select(*_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each group of near-duplicates (five-word shingles, similarity 0.8) the smallest id stays.

    Rows without ``doc_id`` stay; rows that share one go or stay together.
    """
    found = minmax.near_duplicates(docs.select("doc_id", "text"), n=5, percent=80)
    return without(docs, found.filter(~F.col("kept")), "doc_id")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: every secret in a text becomes a mark; ``n_chars`` follows.  No document goes."""
    model = secret_scan.model_for(docs.select("doc_id", "text"))
    names = {c: f"_in_{n}" for n, c in enumerate(docs.columns) if c in ("base_spans", "spans")}
    found = secret_scan.scan(docs.withColumnsRenamed(names), model)
    found = found.withColumn("text", secret_scan.redact(F.col("text"), F.col("spans")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return found.drop("base_spans", "spans").withColumnsRenamed({v: k for k, v in names.items()}).select(*_columns(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: each document appears as often as the mix takes it (not at all, once, twice).

    Rows that share id and source are one unit of the mix and appear equally
    often; rows without ``doc_id`` are units of their own, numbered in a
    written table of theirs, so no key holds them together.
    """
    lone = docs.filter(F.col("doc_id").isNull()).select(F.monotonically_increasing_id().alias("number"), F.struct("*").alias("row"))
    lone = write_scratch(lone, "pipeline-no-id").select(F.concat(F.lit("n"), "number").alias("unit"), "row")
    known = docs.filter(F.col("doc_id").isNotNull()).select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("unit"), F.struct("*").alias("row"))
    rows = known.unionAll(lone).select("unit", F.col("row.source").alias("source"), "row")
    sizes = mixing.sized(rows.select("unit", "source", F.col("row.text").alias("text")), id_col="unit")
    units = sizes.groupBy("doc_id", "source").agg(F.sum("size").alias("size"))
    taken = mixing.mix(units).filter("copies > 0").select("doc_id", "source", "copies").alias("t")
    same = (F.col("r.unit") == F.col("t.doc_id")) & F.col("r.source").eqNullSafe(F.col("t.source"))
    turns = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return rows.alias("r").join(taken, same).select("row", F.explode(turns)).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: pieces of the documents with their sequence and place."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("identify_language", identify_language),
    ("drop_near_duplicates", drop_near_duplicates),
    ("redact_secrets", redact_secrets),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_scratch(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

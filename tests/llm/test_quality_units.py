"""Operator 9: units are whole words, and every document's words have vectors."""

import pyarrow as pa
from llm_fixtures import _library  # noqa: F401

from tabula.llm import quality


def _unit(word):
    return int(quality.units(pa.array([word]))[0][0])


def test_words_that_differ_in_the_stem_are_different_units():
    words = ["great", "treat", "sweat", "повесть", "совесть", "новость", "表現方法", "処理方法", "12345", "54321"]
    assert len({_unit(w) for w in words}) == len(words)


def test_words_outside_the_labelled_rows_have_vectors(spark):
    docs = spark.createDataFrame([(0, "plain words here"), (1, "other words there"), (2, "unlabelled vocabulary stands alone")], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert all(model.vectors[_unit(w)].any() for w in "plain words here other there unlabelled vocabulary stands alone".split())

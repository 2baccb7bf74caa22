"""Targets that contradict each other still give rates."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lumenframe.llm import mixing
from lumenframe.llm.queries import QUERIES

DOCS = "doc_id long, text string, source string, lang string"


def test_sources_of_one_language_each(spark, tmp_path):
    rows = [(1, "w " * 100, "s0", "en"), (2, "w " * 50, "s1", "fr"), (3, None, "s1", "fr")]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    # Least relative entropy to both: the geometric mean of the shares, 100 : 50 to the powers 0.5 and 0.7.
    odds = 2**0.6
    want = {1: odds / (1 + odds) * 150 / 100, 2: 1 / (1 + odds) * 150 / 50, 3: 0.0}
    found = QUERIES["op2_mix_to_targets"](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.rate for r in found} == pytest.approx(want, abs=1e-4)
    drawn = corpus_pipeline.mix_to_targets(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), "").collect()
    assert {(r.doc_id, r.copies) for r in drawn} == {(r.doc_id, r.copies) for r in found if r.copies}


def test_far_apart_targets_stay_numbers(spark):
    rows = [(1, "a b", "s0", "en"), (2, "a b", "s1", "fr"), (3, "a b", "s1", "fr")]
    near = 1 - 1e-6
    margins = {
        "m": mixing.Margin(F.col("source"), named={"s0": near, "s1": 1 - near}),
        "n": mixing.Margin(F.col("lang"), named={"en": 1 - near, "fr": near}),
    }
    out = mixing.mixed(spark.createDataFrame(rows, DOCS), margins=margins).collect()
    assert {r.doc_id: r.rate for r in out} == pytest.approx({1: 1.5, 2: 0.75, 3: 0.75}, abs=1e-3)

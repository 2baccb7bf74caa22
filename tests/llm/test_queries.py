"""Queries against their DuckDB twins, and the pipeline stage by stage."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lumenframe.llm import decontam, quality, simhash
from lumenframe.llm.common import remainder
from lumenframe.llm.queries import ORACLE, QUERIES
from lumenframe.runtime import cut_lineage

from ..conftest import SF
from ..test_oracle import check, rows_of


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, con, name):
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLE[name])
    columns = sorted(df.columns)
    assert sorted(rel.columns) == columns
    got = rows_of(df.select(*columns).collect(), range(len(columns)))
    assert got == rows_of(rel.fetchall(), [rel.columns.index(c) for c in columns])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_whole_result(spark, name):
    found = QUERIES[name](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found.count() == (docs.count() if "doc_id" in found.columns else found.select("query_id").distinct().count() * 5)


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_pipeline(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_duplicates", "decontamination", "mixing"]
    before = cut_lineage(spark.read.parquet(f"{SF}/documents.parquet").withColumns({"fp": F.lit(1), "spans": F.lit("x"), "score_0": F.lit(2)}))
    bench, labels = spark.read.parquet(f"{SF}/benchmark.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = cut_lineage(stage(spark, before, SF))
        old, new = {r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in after.collect()}
        assert set(new) <= set(old) and after.count() == len(new)
        if name != "mixing":
            assert after.columns == before.columns
        if name == "quality":
            model = quality.train(before, labels, learn_from=remainder(F.col("doc_id"), 5) != 0)
            terms = [quality.terms((r.text or "").encode()) for r in old.values()]
            kept = model.score(terms, quality.NEIGHBOURS) >= 0.3
            assert set(new) == {i for i, k in zip(old, kept) if k}
        elif name == "line_dedup":
            lines = [x for r in new.values() for x in (r.text or "").split("\n") if x]
            assert set(new) == set(old) and len(lines) == len(set(lines))
            assert all(r.n_chars == len(r.text) for r in new.values())
            again = {x for r in old.values() for x in (r.text or "").split("\n") if x} - set(lines)
            # What went altogether was within an edit of something earlier.
            assert all(len(x) >= 20 for x in again)
        elif name == "near_duplicates":
            prints = {i: simhash.fingerprint((r.text or "").encode()) % (1 << 64) for i, r in old.items()}
            close = {i: {j for j in old if (prints[i] ^ prints[j]).bit_count() <= 2} for i in old}
            kept = set()
            left = set(old)
            while left:
                group, edge = set(), {min(left)}
                while edge:
                    group |= edge
                    edge = set().union(*(close[i] for i in edge)) - group
                kept.add(min(group))
                left -= group
            assert set(new) == kept
        elif name == "decontamination":
            index = decontam.Index([(r.item_id, (r.text or "").encode()) for r in bench.collect()], 10, 6)
            assert set(new) == {i for i, r in old.items() if not index.hits((r.text or "").encode())[1]}
        else:
            assert after.columns == [*before.columns, "n_words", "rate", "copies"]
            assert all(r.copies >= 1 and int(r.rate) <= r.copies <= int(r.rate) + 1 for r in new.values())
            whole = sum(len((r.text or "").split()) for r in old.values())
            drawn = sum(r.copies * r.n_words for r in new.values())
            assert 0.6 * whole < drawn < 1.4 * whole
        before = after


def test_pipeline_on_empty_tables(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

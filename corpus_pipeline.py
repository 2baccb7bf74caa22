"""From raw documents to a training mix: five stages over the table of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenframe.llm import decontam, linededup, mixing, quality, simhash
from lumenframe.llm.common import remainder
from lumenframe.runtime import cut_lineage, ship_package, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the neighbour vote takes for low quality."""
    ship_package(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"), learn_from=remainder(F.col("doc_id"), 5) != 0)
    name = next(n for n in (f"score_{i}" for i in range(len(docs.columns) + 1)) if n not in docs.columns)
    return quality.score(docs, model, docs.columns, name=name).where(F.col(name) >= 0.3).drop(name)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out lines that stood before in the corpus, exactly or at one edit."""
    out = linededup.dedup_lines(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every group of fingerprints over three-word shingles linked at two or fewer differing bits: the smallest id, then the first text."""
    ship_package(spark)
    return simhash.keep_one(docs, width=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold ten consecutive words of a benchmark item, or a whole shorter one."""
    ship_package(spark)
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw documents so that sources, languages and forms meet their target shares of tokens."""
    return mixing.mixed(docs).where("copies > 0")


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("mixing", mix_to_targets),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs


# The quality model and the fingerprints are not expressible in SQL.
ORACLE_SQL = None

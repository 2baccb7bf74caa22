"""Latent semantic index: truncated SVD of the tf-idf matrix and search over it.

The SVD is a randomised block Krylov iteration: every pass multiplies a thin block by the
matrix and its transpose, document by document, and hands on sums of the size of the
block.  Only the term side (vocabulary x concepts, both parameters) is ever local; the
document side stays a keyed table, and its factors are a projection row by row, without
a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage, few_tasks
from .ordering import top_per_group
from .text import each_term, lemmatised, query_weights, row_total, term_counts, token_array, vocabulary

DOC = "doc_id"
# Matrix entries of a dense block of documents inside a task.
ENTRIES = 1 << 22
# Words a task looks up at once.
HELD_WORDS = 1 << 19
# Passes at most, and the residual of a concept, as a share of its eigenvalue, that ends them.
MAX_PASSES = 12
TOLERANCE = 1e-6


@dataclass
class SemanticIndex:
    """Tables of the index: ``terms`` (term, term_id, df, idf, v) and ``rows`` (doc_id, ids, weights:
    the tf-idf of a document's terms), the term factors and the singular values."""

    terms: DataFrame
    rows: DataFrame
    factors: np.ndarray
    singular: list[float]

    @property
    def k(self) -> int:
        return len(self.singular)

    @property
    def weights(self) -> DataFrame:
        """(doc_id, term_id, weight): the tf-idf matrix in long form."""
        each = F.explode(F.arrays_zip("ids", "weights")).alias("e")
        return self.rows.select(DOC, each).select(DOC, F.col("e.ids").alias("term_id"), F.col("e.weights").alias("weight"))

    def scaled_documents(self) -> DataFrame:
        """(doc_id, us): rows of U * s, as weights x V; documents without a known term have none."""
        v = self.rows.sparkSession.sparkContext.broadcast(self.factors)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = np.zeros((b.num_rows, v.value.shape[1]))
                for start, dense in _dense(b, len(v.value)):
                    found[start : start + len(dense)] = dense @ v.value
                yield pa.RecordBatch.from_arrays([b.column(DOC), pa.array(list(found), pa.list_(pa.float64()))], names=[DOC, "us"])

        kind = self.rows.schema[DOC].dataType.simpleString()
        return self.rows.where(F.size("ids") > 0).mapInArrow(run, f"{DOC} {kind}, us array<double>")

    def documents(self) -> DataFrame:
        """(doc_id, u): rows of U."""
        s = F.array(*[F.lit(float(x)) for x in self.singular])
        return self.scaled_documents().select(
            DOC, F.zip_with("us", s, lambda x, y: x / F.nullif(y, F.lit(0.0))).alias("u")
        )

    def singular_values(self) -> DataFrame:
        spark = self.terms.sparkSession
        return spark.createDataFrame(
            [(i, float(x)) for i, x in enumerate(self.singular)], "concept int, singular double"
        )


MAX_STOP_WORDS = 10_000


def word_table(docs: DataFrame, text: str = "text", stop: list[str] | None = None, lemmas: DataFrame | None = None) -> DataFrame:
    """(doc_id, words): kept tokens of each text, as lemmas and without stop words.

    Stop words are a list of bounded size and leave within the row.  ``lemmas`` (term,
    lemma) may have any size; a text's words are then looked up one by one and gathered
    again.  Texts without a word left keep an empty array.
    """
    if len(stop or []) > MAX_STOP_WORDS:
        raise ValueError(f"more than {MAX_STOP_WORDS} stop words")
    rows = docs.select(DOC, F.coalesce(token_array(F.col(text)), F.array().cast("array<string>")).alias("words"))
    if lemmas is not None:
        each = lemmatised(each_term(rows.withColumnRenamed("words", "_w"), DOC), lemmas)
        words = each.groupBy(DOC).agg(F.collect_list("term").alias("_kept"))
        rows = rows.select(DOC).join(words, DOC, "left").select(DOC, F.coalesce("_kept", F.array()).alias("words"))
    if stop:
        rows = rows.withColumn("words", F.filter("words", lambda w: ~w.isin(stop)))
    return rows


def bag_of_arrays(words: DataFrame) -> DataFrame:
    return term_counts(words.withColumnRenamed("words", "_w"), DOC)


def _dense(batch: pa.RecordBatch, n_terms: int) -> Iterator[tuple[int, np.ndarray]]:
    """Dense blocks of bounded size of a batch of (ids, weights), each with the place of its first row."""
    sizes = np.asarray(pc.list_value_length(batch.column("ids")))
    ids, weights = (pc.list_flatten(batch.column(c)).to_numpy(zero_copy_only=False) for c in ("ids", "weights"))
    ends = np.cumsum(sizes)
    step = max(1, ENTRIES // max(n_terms, 1))
    for start in range(0, len(sizes), step):
        own = sizes[start : start + step]
        low, high = ends[start] - sizes[start], ends[min(start + step, len(sizes)) - 1]
        dense = np.zeros((len(own), n_terms))
        dense[np.repeat(np.arange(len(own)), own), ids[low:high]] = weights[low:high]
        yield start, dense


def _slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with no more than ``most`` elements in ``column``, or of a single row."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(batch.column(column)), 0)))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right"))
        end = max(end, start + 1)
        yield batch.slice(start, end - start)
        start = end


def indexed(words: DataFrame, names: list[str], idf: list[float]) -> DataFrame:
    """(doc_id, ids, weights): the terms of every document that are in the vocabulary, by id, with
    idf * tf / all words of the text."""
    shared = words.sparkSession.sparkContext.broadcast((pa.array(names, pa.string()), np.array(idf)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weight = shared.value
        n = max(len(known), 1)
        for b in (part for batch in batches for part in _slices(batch, "words", HELD_WORDS)):
            sizes = np.asarray(pc.fill_null(pc.list_value_length(b.column("words")), 0))
            found = pc.index_in(pc.list_flatten(b.column("words")), value_set=known)
            held = np.asarray(pc.is_valid(found))
            place = np.repeat(np.arange(len(sizes)), sizes)[held] * n + np.asarray(pc.drop_null(found))
            cells, counts = np.unique(place, return_counts=True)
            row, term = cells // n, cells % n
            offsets = pa.array(np.searchsorted(row, np.arange(len(sizes) + 1)), pa.int32())
            values = counts / sizes[row] * weight[term] if len(cells) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [b.column(DOC), pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(values, pa.float64()))],
                names=[DOC, "ids", "weights"],
            )

    kind = words.schema[DOC].dataType.simpleString()
    return words.select(DOC, "words").mapInArrow(run, f"{DOC} {kind}, ids array<int>, weights array<double>")


def gram_product(rows: DataFrame, block: np.ndarray) -> np.ndarray:
    """A'(A block) for the matrix A of all documents: one pass, sums of the block's size."""
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(shared.value)
        for b in batches:
            for _, dense in _dense(b, len(total)):
                total += dense.T @ (dense @ shared.value)
        held = np.flatnonzero((total != 0).any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(list(total[held]), pa.list_(pa.float64()))], names=["i", "v"])

    parts = few_tasks(rows.select("ids", "weights")).mapInArrow(run, "i int, v array<double>")
    summed = parts.groupBy("i").agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v"))
    out = np.zeros_like(block)
    for r in summed.toLocalIterator():  # one row per term
        out[r["i"]] = r["v"]
    shared.destroy()
    return out


def leading_factors(rows: DataFrame, n_terms: int, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The k largest singular values and right singular vectors, by block Krylov iteration.

    Every pass adds the product of the last block, made orthogonal to all before, to the
    basis; the best approximation within the whole basis converges much faster than the
    last block alone.  Passes end when each of the k has a small residual.
    """
    width = min(2 * k + 10, n_terms)
    block = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_terms, width)))[0]
    basis, images = np.zeros((n_terms, 0)), np.zeros((n_terms, 0))
    for _ in range(MAX_PASSES):
        image = gram_product(rows, block)
        basis, images = np.hstack([basis, block]), np.hstack([images, image])
        small = basis.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1][:k], turn[:, ::-1][:, :k]
        v = basis @ turn
        left = np.linalg.norm(images @ turn - v * values, axis=0)
        if (left <= TOLERANCE * np.maximum(values, TOLERANCE * values[0])).all() or basis.shape[1] >= n_terms:
            break
        for _ in range(2):  # twice is enough to make it orthogonal in double precision
            image = image - basis @ (basis.T @ image)
            image = np.linalg.qr(image)[0]
        block = image[:, : min(width, n_terms - basis.shape[1])]
    return np.sqrt(np.maximum(values, 0.0)), v


def fit(words: DataFrame, n_terms: int = 5000, k: int = 25) -> SemanticIndex:
    """Index documents given as (doc_id, words)."""
    vocab = vocabulary(bag_of_arrays(words), row_total(words), n_terms)
    local = vocab.orderBy("term_id").collect()  # at most n_terms rows
    names, idf = [r["term"] for r in local], [float(r["idf"]) for r in local]
    rows = cut_lineage(indexed(words, names, idf))
    s, v = leading_factors(rows, len(names), min(k, len(names))) if names else (np.zeros(0), np.zeros((0, 0)))
    if names:
        # Signs are arbitrary: make the largest entry of every concept positive.
        peak = v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])]
        v = v * np.where(peak < 0, -1.0, 1.0)
    terms = words.sparkSession.createDataFrame(
        [(n, i, int(r["df"]), idf[i], [float(x) for x in v[i]]) for i, (n, r) in enumerate(zip(names, local))],
        "term string, term_id int, df bigint, idf double, v array<double>",
    )
    return SemanticIndex(terms, rows, v, [float(x) for x in s])


def _long(df: DataFrame, keep: list[str], vector: str) -> DataFrame:
    return df.select(*keep, F.posexplode(vector).alias("concept", "weight"))


def top_terms_per_concept(index: SemanticIndex, n: int = 25) -> DataFrame:
    long = _long(index.terms, ["term"], "v")
    return top_per_group(long, ["concept"], [F.desc("weight"), F.col("term")], n)


def top_docs_per_concept(index: SemanticIndex, n: int = 25) -> DataFrame:
    long = _long(index.documents(), [DOC], "u")
    return top_per_group(long, ["concept"], [F.desc("weight"), F.col(DOC)], n)


def top_genres_per_concept(
    index: SemanticIndex, docs: DataFrame, genre: str, n_docs: int = 25, n: int = 5
) -> DataFrame:
    """Most frequent genres among the top documents of each concept: one join."""
    tops = F.broadcast(top_docs_per_concept(index, n_docs))  # concepts x n_docs rows
    found = docs.select(DOC, F.col(genre).alias("genre")).join(tops, DOC)
    counts = found.groupBy("concept", "genre").agg(F.count(F.lit(1)).alias("n"))
    return top_per_group(counts, ["concept"], [F.desc("n"), F.col("genre")], n)


def search(index: SemanticIndex, words: list[str], n: int | None = 25) -> DataFrame:
    """(doc_id, score): cosine between the projected query and every document.

    Documents without any known term have no direction and no score.
    """
    k = index.k
    q = query_weights(index.terms, words).select("term", "idf").join(index.terms.select("term", "v"), "term")
    projected = q.agg(
        F.array(*[F.sum(F.col("idf") * F.get("v", F.lit(c))) for c in range(k)])
    ).scalar()
    docs = index.scaled_documents().select(DOC, "us", projected.alias("q"))

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    us, qv = F.col("us"), F.col("q")
    cosine = dot(us, qv) / F.nullif(F.sqrt(dot(us, us)) * F.sqrt(dot(qv, qv)), F.lit(0.0))
    scored = docs.select(DOC, cosine.alias("score")).where(F.col("score").isNotNull() & ~F.isnan("score"))
    return scored if n is None else scored.orderBy(F.desc("score"), DOC).limit(n)


def concept_report(
    index: SemanticIndex, docs: DataFrame, title: str, genre: str, n: int = 25, n_genres: int = 5
) -> DataFrame:
    """(concept, terms, docs, genres): one line each, in rank order."""

    def joined(df: DataFrame, column: str, out: str) -> DataFrame:
        # Lists are limited to the top n of each concept.
        return df.groupBy("concept").agg(
            F.concat_ws(
                ", ",
                F.transform(
                    F.array_sort(F.collect_list(F.struct("rank", F.col(column).alias("x")))), lambda e: e.x
                ),
            ).alias(out)
        )

    tops = top_docs_per_concept(index, n)
    titled = docs.select(DOC, F.col(title).cast("string").alias("_title")).join(F.broadcast(tops), DOC)
    genres = top_genres_per_concept(index, docs, genre, n, n_genres)
    return (
        joined(top_terms_per_concept(index, n), "term", "terms")
        .join(joined(titled, "_title", "docs"), "concept")
        .join(joined(genres, "genre", "genres"), "concept")
    )


def report_lines(report: DataFrame, n_genres: int = 5) -> Column:
    """Lines of the printed report.  Fixed values: its labels."""
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Concept terms: "), "terms"),
        F.concat(F.lit("Concept docs: "), "docs"),
        F.concat(F.lit(f"Top-{n_genres} frequent genres: "), "genres"),
        F.lit(""),
    )

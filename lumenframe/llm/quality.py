"""Quality scores by similarity-weighted votes of labelled neighbours in a latent space."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, carried, ddl, pieces

# Hashed terms, latent dimensions, and labelled rows kept: the model has a fixed size.
TERMS = 1 << 12
RANK = 64
LABELLED = 8192
NEIGHBOURS = 25
# Documents whose cosines with all labelled rows are computed at once.
BLOCK = 512

_SHAPE = bytes(
    65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


def terms(data: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed terms of a text and their counts.

    A word gives its letters in lower case, its shape (upper, lower, digit, and other signs
    as they are, runs written once) and whether it repeats the word before.
    """
    words = data.split() if data else []
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    shapes = _RUN.sub(rb"\1", b" ".join(words).translate(_SHAPE)).split(b" ")
    lowered = b" ".join(words).lower().split(b" ")
    again = sum(map(bytes.__eq__, lowered, lowered[1:]))
    hashed = np.concatenate(
        [np.fromiter(map(zlib.crc32, lowered), np.int64, len(words)) % (TERMS // 2),
         TERMS // 2 + 1 + np.fromiter(map(zlib.crc32, shapes), np.int64, len(shapes)) % (TERMS // 2 - 1),
         np.full(again, TERMS // 2)]
    )
    return np.unique(hashed, return_counts=True)


@dataclass
class Model:
    """Term weights, term-to-latent matrix, and the labelled rows as unit vectors."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def embed(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Unit latent vectors; zero where a text has no term."""
        out = np.zeros((len(rows), self.axes.shape[1]), np.float32)
        for i, (term, count) in enumerate(rows):
            if len(term):
                out[i] = _weigh(term, count, self.weights) @ self.axes[term]
        return _unit(out)

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
        """Share of label 1 among the k nearest labelled rows, weighted by squared cosine."""
        vectors, out = self.embed(rows), np.full(len(rows), self.prior)
        k = min(k, len(self.labels))
        if not k:
            return out
        for at in range(0, len(rows), BLOCK):
            block = vectors[at : at + BLOCK]
            cosine = block @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.square(np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64))
            total = weight.sum(axis=1)
            vote = (weight * self.labels[near]).sum(axis=1)
            seen = total > 0
            out[at : at + BLOCK][seen] = np.clip(vote[seen] / total[seen], 0, 1)
        return out


def _weigh(term: np.ndarray, count: np.ndarray, weights: np.ndarray) -> np.ndarray:
    value = ((1 + np.log(count)) * weights[term]).astype(np.float32)
    return value / max(float(np.sqrt((value * value).sum())), 1e-12)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


def document_frequency(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """Documents that hold each hashed term, over all rows, and the number of rows.

    A task hands on one row of ``TERMS`` counts per piece of input it was given, summed
    by Spark; the result has a fixed size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for data in byte_texts(batch.column(0)):
                counts[terms(data)[0]] += 1
                rows += 1
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*held.tolist(), -1], pa.int32()), pa.array([*counts[held].tolist(), rows], pa.int64())],
            names=["term", "n"],
        )

    summed = docs.select(F.col(text).alias("text")).mapInArrow(run, "term int, n bigint")
    out, rows = np.zeros(TERMS, np.int64), 0
    for row in summed.groupBy("term").agg(F.sum("n").alias("n")).collect():
        if row["term"] < 0:
            rows = row["n"]
        else:
            out[row["term"]] = row["n"]
    return out, rows


def _labelled_terms(docs: DataFrame, labels: DataFrame, limit: int) -> pa.Table:
    """Hashed terms and label of at most ``limit`` labelled documents, picked by a hash of the id.

    Only the picked ids, whose number is bounded, are broadcast to find their texts.
    """
    picked = labels.orderBy(F.xxhash64(F.lit("labelled"), "doc_id"), "doc_id").limit(limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [terms(data) for data in byte_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"),
                 pa.array([r[0].tolist() for r in rows], pa.list_(pa.int32())),
                 pa.array([r[1].tolist() for r in rows], pa.list_(pa.int32()))],
                names=["doc_id", "label", "term", "n"],
            )

    kind = labels.schema["doc_id"].dataType.simpleString()
    found = docs.join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text")
    found = found.mapInArrow(run, f"doc_id {kind}, label double, term array<int>, n array<int>")
    # A doc_id may be repeated in the documents: still no more than the limit.
    return found.orderBy(F.xxhash64(F.lit("labelled"), "doc_id"), "doc_id", F.xxhash64("term", "n")).limit(limit).toArrow()


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    learn_from: Column | None = None,
    labelled: int = LABELLED,
    rank: int = RANK,
) -> Model:
    """Latent-semantic model with labelled rows.

    Term weights come from document frequencies over all documents.  At most ``labelled``
    labelled documents, picked by a hash of their id, give the latent axes (randomised SVD of their
    term matrix) and are kept as voters.  ``learn_from`` is a condition on ``doc_id`` for
    labels that may be used.  Labels that are null are passed over; several labels of one
    document are averaged.  Without any label the prior is one half and nobody votes.
    """
    known = labels.where(learn_from) if learn_from is not None else labels
    known = known.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("label"))
    known = known.dropna().groupBy("doc_id").agg(F.avg("label").alias("label"))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    frequency, n = document_frequency(docs, text)
    weights = np.log((1 + n) / (1 + frequency)) + 1e-3
    rows = _labelled_terms(texts, known, labelled)
    marks = rows.column("label").to_numpy().astype(np.float64)
    prior = float(marks.mean()) if len(marks) else 0.5
    matrix = np.zeros((len(marks), TERMS), np.float32)
    sizes = np.asarray(pc.list_value_length(rows.column("term")))
    term, count = (pc.list_flatten(rows.column(c)).to_numpy().astype(np.int64) for c in ("term", "n"))
    ends = np.cumsum(sizes)
    for i, (start, end) in enumerate(zip(ends - sizes, ends)):
        if end > start:
            matrix[i, term[start:end]] = _weigh(term[start:end], count[start:end].astype(np.float64), weights)
    axes = _axes(matrix, rank)
    vectors = _unit(matrix @ axes)
    voters = np.flatnonzero((vectors != 0).any(axis=1))
    return Model(weights, axes, vectors[voters], marks[voters], prior)


def _axes(matrix: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors by randomised subspace iteration."""
    rank = min(rank, *matrix.shape) if matrix.size else 0
    if not rank:
        return np.zeros((matrix.shape[1], 1), np.float32)
    rng = np.random.default_rng(7)
    base = rng.standard_normal((matrix.shape[1], min(rank + 16, min(matrix.shape)))).astype(np.float32)
    for _ in range(4):
        base, _r = np.linalg.qr(matrix.T @ (matrix @ base))
    _u, _s, right = np.linalg.svd(matrix @ base, full_matrices=False)
    return np.ascontiguousarray((base @ right.T)[:, :rank])


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", name: str = "score", k: int = NEIGHBOURS) -> DataFrame:
    """The columns ``keep`` and the score (0 to 1, higher: label 1 likelier) of every row.

    The documents are only mapped over; the model, of a fixed size, is broadcast.  Null,
    empty and termless texts get the prior.  Repeated rows come back repeated.  Column names
    cannot clash but for ``name`` itself, which must not be among those kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    taken, back = carried(docs, keep)
    rows = docs.select(*taken)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            scores = shared.value.score([terms(data) for data in byte_texts(piece.column("text"))], k)
            columns = [piece.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], names=[*names, "score"])

    both = docs.select(*taken, F.col(f"`{text}`").alias("text"))
    scored = both.mapInArrow(run, ", ".join([ddl(rows), "score double"]))
    return scored.select(*back, F.col("score").alias(name))

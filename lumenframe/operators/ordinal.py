"""Ordered scores of texts: proportional-odds regression on hashed terms.

P(score <= j) = s(cut_j - x.beta): one weight per hashed term for all levels, one cut
between neighbouring levels.  Every step of the solver reads the rows once and adds up the
gradient, whose size is the number of hashed terms whatever the number of texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage, few_tasks


@dataclass
class OrderedModel:
    """``levels`` ordered labels, ``cuts`` between them, ``beta`` and ``idf`` per hashed term."""

    levels: list[int]
    cuts: np.ndarray
    beta: np.ndarray
    idf: np.ndarray

    def probabilities(self, margin: np.ndarray) -> np.ndarray:
        """One column per level; rows add up to one."""
        below = sigmoid(self.cuts[None, :] - margin[:, None])
        edges = np.hstack([np.zeros((len(margin), 1)), below, np.ones((len(margin), 1))])
        return np.diff(edges, axis=1)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def hashed_terms(words: Column, size: int) -> Column:
    """Places of the words among ``size`` hashed terms; repeated words are repeated."""
    return F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda w: F.pmod(F.xxhash64(w), F.lit(size)).cast("int"))


def _cuts(params: np.ndarray, levels: int) -> np.ndarray:
    """Rising cuts: the first, then the logarithms of the steps between them."""
    return params[0] + np.concatenate([[0.0], np.cumsum(np.exp(params[1 : levels - 1]))])


def _entries(ids: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, weight) of all words: their idf over the root of the text's length."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(ids), 0))
    term = pc.list_flatten(ids).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    return row, term, idf[term] / np.sqrt(sizes[row])


def gradient(params: np.ndarray, row: np.ndarray, term: np.ndarray, weight: np.ndarray, level: np.ndarray, levels: int) -> np.ndarray:
    """Loss, then its gradient by the parameters of the cuts and by beta, summed over rows."""
    k = levels - 1
    cuts, beta = _cuts(params[:k], levels), params[k:]
    margin = np.bincount(row, weight * beta[term], len(level))
    edges = np.concatenate([[-np.inf], cuts, [np.inf]])
    upper, lower = sigmoid(edges[level + 1] - margin), sigmoid(edges[level] - margin)
    chance = np.maximum(upper - lower, 1e-300)
    # (s'(a) - s'(b)) / (s(a) - s(b)) = 1 - s(a) - s(b): no small difference is divided by.
    by_margin = 1 - upper - lower
    by_cut = np.bincount(level, upper * (1 - upper) / chance, levels)[:k] - np.bincount(level, lower * (1 - lower) / chance, levels)[1:]
    by_step = by_cut[::-1].cumsum()[::-1]
    by_params = np.concatenate([by_step[:1], by_step[1:] * np.exp(params[1:k])])
    by_beta = np.bincount(term, weight * by_margin[row], len(beta))
    return np.concatenate([[-np.log(chance).sum()], -by_params, by_beta])


def minimise(value: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int, memory: int = 8, tolerance: float = 1e-6) -> np.ndarray:
    """Limited-memory quasi-Newton steps with backtracking."""
    x, (f, g) = start, value(start)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.abs(g).max() <= tolerance:
            break
        d, kept = -g, []
        for s, y in reversed(pairs):
            a = s @ d / (s @ y)
            d = d - a * y
            kept.append(a)
        if pairs:
            d = d * (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1])
        else:
            d = d / max(1.0, np.linalg.norm(g))
        for (s, y), a in zip(pairs, reversed(kept)):
            d = d + s * (a - y @ d / (s @ y))
        size = 1.0
        while size > 1e-8:
            there = x + size * d
            f2, g2 = value(there)
            if f2 <= f + 1e-4 * size * (g @ d):
                break
            size /= 2
        else:
            break
        if (there - x) @ (g2 - g) > 1e-12:
            pairs = [*pairs, (there - x, g2 - g)][-memory:]
        x, f, g = there, f2, g2
    return x


def fit(rows: DataFrame, words: str, label: str, size: int = 1 << 14, penalty: float = 1e-3, steps: int = 40) -> OrderedModel:
    """Fit on rows with an array of words and an ordered whole-number label.

    Rows without a label are passed over.  Levels are the labels that occur, in their
    order; with fewer than two there is nothing to fit and beta is zero.
    """
    known = cut_lineage(
        rows.where(F.col(label).isNotNull()).select(hashed_terms(F.col(words), size).alias("ids"), F.col(label).cast("int").alias("label"))
    )
    levels = sorted(r[0] for r in known.select("label").distinct().collect())  # as many as there are scores
    n = known.count()
    if len(levels) < 2:
        return OrderedModel(levels, np.zeros(0), np.zeros(size), np.zeros(size))
    df = np.zeros(size)
    for r in known.select(F.explode(F.array_distinct("ids")).alias("t")).groupBy("t").count().toLocalIterator():
        df[r["t"]] = r["count"]
    idf = np.log((n + 1) / (df + 1))
    place = np.array(levels)
    spark, k = rows.sparkSession, len(levels) - 1

    def value(params: np.ndarray) -> tuple[float, np.ndarray]:
        shared = spark.sparkContext.broadcast((params, idf))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, weights = shared.value
            total = np.zeros(len(at) + 1)
            for b in batches:
                if b.num_rows:
                    level = np.searchsorted(place, b.column("label").to_numpy())
                    total += gradient(at, *_entries(b.column("ids"), weights), level, len(place))
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["s"])

        parts = few_tasks(known).mapInArrow(run, "s array<double>")
        found = np.array(parts.agg(vector_to_array(Summarizer.sum(array_to_vector("s"))).alias("s")).first()["s"]) / n
        shared.destroy()
        beta = params[k:]
        return found[0] + penalty / 2 * beta @ beta, found[1:] + np.concatenate([np.zeros(k), penalty * beta])

    shares = np.array([r["count"] for r in known.groupBy("label").count().orderBy("label").collect()]) / n
    cuts = np.log(np.cumsum(shares)[:-1] / (1 - np.cumsum(shares)[:-1]))
    start = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-6)), np.zeros(size)])
    found = minimise(value, start, steps)
    return OrderedModel(levels, _cuts(found[:k], k + 1), found[k:], idf)


def score(rows: DataFrame, model: OrderedModel, words: str, keep: list[str]) -> DataFrame:
    """Columns ``keep``, the likeliest score, the mean score and the probability of every level."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    inner = [f"_k{i}" for i in range(len(keep))]
    chosen = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, inner)], hashed_terms(F.col(words), len(model.beta)).alias("_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            row, term, weight = _entries(b.column("_ids"), m.idf)
            chance = m.probabilities(np.bincount(row, weight * m.beta[term], b.num_rows))
            levels = np.array(m.levels)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in inner), pa.array(levels[chance.argmax(axis=1)].astype(np.int32)), pa.array(chance @ levels), pa.array(list(chance), pa.list_(pa.float64()))],
                names=[*inner, "score", "mean_score", "probabilities"],
            )

    kinds = ", ".join([*(f"{n} {rows.schema[c].dataType.simpleString()}" for c, n in zip(keep, inner)), "score int, mean_score double, probabilities array<double>"])
    found = chosen.where(F.lit(bool(model.levels))).mapInArrow(run, kinds)
    return found.select(*[F.col(n).alias(c) for c, n in zip(keep, inner)], "score", "mean_score", "probabilities")

"""Model trees: a linear model at every node, pruned by adjusted error and smoothed along the path.

Spark grows the tree.  One pass gathers the moments of its leaves; those of inner nodes are
their sums, so every node's model is solved without touching the rows again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ols, trees

# Weight, in rows, of the parent's model against a node's own.
SMOOTHING = 15.0


@dataclass
class Moments:
    """Rows, means and co-moments of (terms, label) in a node."""

    n: float
    mean: np.ndarray
    cov: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        a, b = self.n / n, other.n / n
        gap = self.mean - other.mean
        return Moments(n, a * self.mean + b * other.mean, a * self.cov + b * other.cov + a * b * np.outer(gap, gap))


@dataclass
class ModelTree:
    """``nodes`` as Spark grew them, which of them end the pruned tree, and the smoothed model
    (intercept, then a coefficient per term) of each of these."""

    nodes: trees.Nodes
    ends: np.ndarray
    models: np.ndarray


def linear_model(m: Moments, ridge: float = 1e-6) -> tuple[np.ndarray, float]:
    """(intercept and coefficients, adjusted error) of the terms worth their place.

    The error is the root mean square on the node's rows times (n + v) / (n - v) for v
    parameters.  Terms leave one by one, the least useful first, while that falls; a
    constant model is what is left of terms that explain nothing.
    """
    k = len(m.mean) - 1
    scale = np.sqrt(np.maximum(np.diag(m.cov)[:k], 0))
    kept = np.flatnonzero(scale > 1e-12 * np.maximum(1.0, np.abs(m.mean[:k])))

    def solved(terms: np.ndarray) -> tuple[float, np.ndarray]:
        a, b = m.cov[np.ix_(terms, terms)], m.cov[terms, k]
        beta = np.linalg.solve(a + ridge * np.diag(np.diag(a)), b) if len(terms) else np.zeros(0)
        square = max(m.cov[k, k] - 2 * beta @ b + beta @ a @ beta, 0.0)
        v = len(terms) + 1
        return (np.sqrt(square) * (m.n + v) / (m.n - v) if m.n > v else np.inf), beta

    error, beta = solved(kept)
    while len(kept):
        tries = [solved(np.delete(kept, i)) for i in range(len(kept))]
        least = min(range(len(kept)), key=lambda i: tries[i][0])
        if tries[least][0] > error:
            break
        kept, (error, beta) = np.delete(kept, least), tries[least]
    model = np.zeros(k + 1)
    model[1 + kept] = beta
    model[0] = m.mean[k] - beta @ m.mean[kept]
    return model, float(error)


def grow(nodes: trees.Nodes, leaves: dict[int, Moments], smoothing: float = SMOOTHING) -> ModelTree:
    """The pruned and smoothed tree, from the moments of its leaves (a leaf without any is passed over)."""
    size = len(nodes.left)
    moments: list[Moments | None] = [leaves.get(i) for i in range(size)]
    models, errors, ends = {}, np.full(size, np.inf), np.ones(size, bool)
    for i in reversed(range(size)):
        below = [] if nodes.left[i] < 0 else [j for j in (nodes.left[i], nodes.right[i]) if moments[j] is not None]
        if below:
            moments[i] = moments[below[0]] if len(below) == 1 else moments[below[0]] + moments[below[1]]
        if moments[i] is None:
            continue
        models[i], own = linear_model(moments[i])
        split = sum(moments[j].n * errors[j] for j in below) / moments[i].n if len(below) == 2 else np.inf
        ends[i] = not (split < own)
        errors[i] = min(own, split)
    smoothed = np.zeros((size, len(next(iter(models.values()), np.zeros(1)))))
    for i in range(size):
        at = i
        while at not in models and nodes.parent[at] >= 0:  # a leaf without rows takes the model above
            at = int(nodes.parent[at])
        if at not in models:
            continue
        model = models[at]
        while nodes.parent[at] >= 0:
            up = int(nodes.parent[at])
            n = moments[at].n
            model = (n * model + smoothing * models[up]) / (n + smoothing)
            at = up
        smoothed[i] = model
    return ModelTree(nodes, ends, smoothed)


def learner(terms: list[str], depth: int = 5, smallest: int | None = None) -> DecisionTreeRegressor:
    """The tree under the models; a leaf holds twice as many rows as there are terms."""
    return DecisionTreeRegressor(maxDepth=depth, minInstancesPerNode=smallest or 2 * len(terms), seed=7)


def fit(train: DataFrame, terms: list[str], depth: int = 5, smallest: int | None = None, nodes: trees.Nodes | None = None) -> ModelTree:
    """Grow on rows with label, features and the columns ``terms``; ``nodes`` of a tree grown already may be given."""
    if nodes is None:
        nodes = trees.nodes_of(train.sparkSession, learner(terms, depth, smallest).fit(train))

    def work(nodes: trees.Nodes, paths: np.ndarray, more: dict) -> dict:
        return {"leaf": paths[-1][:, 0].astype(np.int32)}

    placed = trees.score(train, nodes, [*terms, "label"], work, {}, "leaf int")
    found = {}
    for r in ols.moments(placed, ["leaf"], [*terms, "label"]).collect():  # one row per leaf
        found[r["leaf"]] = Moments(float(r["n"]), np.array(r["mean"], float), ols._square(np.asarray(r["comoment"], float), len(terms) + 1))
    return grow(nodes, found)


def predict(rows: DataFrame, model: ModelTree, terms: list[str], keep: list[str]) -> DataFrame:
    """Columns ``keep`` and the prediction; null where a term is null."""
    falls = np.where(model.ends, 0.0, np.inf)
    models = model.models

    def work(nodes: trees.Nodes, paths: np.ndarray, more: dict) -> dict:
        along = paths[:, :, 0]
        at = along[(falls[along] <= 0).argmax(axis=0), np.arange(along.shape[1])]
        x = np.array(more["terms"].flatten().to_numpy(zero_copy_only=False), float).reshape(len(at), -1)
        p = models[at, 0] + (models[at, 1:] * x).sum(axis=1)
        return {"prediction": pa.array(p, mask=np.isnan(p))}

    values = F.array(*[F.coalesce(F.col(f"`{t}`").cast("double"), F.lit(float("nan"))) for t in terms])
    return trees.score(rows, model.nodes, keep, work, {"terms": values}, "prediction double")

"""Cross-validated grids of trees and forests that share their fits.

A shallower tree is the deep one cut back, and a smaller forest the first trees of a large
one.  So one fit per fold and setting of the other parameters, the deepest with the most
trees, gives the scores of all depths and sizes in one pass over the held-out rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import trees
from .metrics import area_under_roc

SMALLER_IS_BETTER = ("mse", "rmse", "mae")
# Scores are told apart by so many decimals, so equal votes added in another order stay equal.
DECIMALS = 12


def _votes(nodes: trees.Nodes, paths: np.ndarray, forms: list[tuple[int, int]]) -> np.ndarray:
    """Mean over the first trees, at a depth, of each form: (forms, rows) or (forms, rows, classes)."""
    value = nodes.value
    by_depth: dict[int, np.ndarray] = {}
    out = []
    for depth, size in forms:
        if depth not in by_depth:
            by_depth[depth] = np.cumsum(value[paths[min(depth, len(paths) - 1)]], axis=1)
        out.append(by_depth[depth][:, size - 1] / size)
    return np.array(out)


def _counted(setting: np.ndarray, *columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct combinations and how often each stands."""
    found, n = np.unique(np.column_stack([setting, *columns]), axis=0, return_counts=True)
    return list(found.T), n


def _scored(rows: DataFrame, nodes: trees.Nodes, forms: list[tuple[int, int]], metric: str) -> DataFrame:
    """What the metric needs of the held-out rows, counted or summed within each batch."""

    def work(nodes: trees.Nodes, paths: np.ndarray, more: dict) -> dict:
        truth = more["label"].to_numpy(zero_copy_only=False)
        found = _votes(nodes, paths, forms)
        setting = np.repeat(np.arange(len(forms)), len(truth))
        labels = np.tile(truth, len(forms))
        if metric == "auc":
            score = np.round(found[:, :, 1], DECIMALS) if found.shape[2] > 1 else np.zeros(found.shape[:2])
            (at, s, y), n = _counted(setting, score.ravel(), labels)
            return {"setting": at.astype(np.int32), "score": s, "label": y, "n": n.astype(np.int64)}
        if metric in ("f1", "accuracy"):
            (at, guess, y), n = _counted(setting, np.round(found, DECIMALS).argmax(axis=2).ravel(), labels)
            return {"setting": at.astype(np.int32), "score": guess.astype(float), "label": y, "n": n.astype(np.int64)}
        gap = truth - found
        sums = [np.full(len(gap), float(len(truth))), (gap * gap).sum(1), np.abs(gap).sum(1), np.full(len(gap), truth.sum()), np.full(len(gap), truth @ truth)]
        return {"setting": np.arange(len(forms), dtype=np.int32), "sums": pa.array(list(np.array(sums).T), pa.list_(pa.float64()))}

    out = "setting int, score double, label double, n bigint" if metric in ("auc", "f1", "accuracy") else "setting int, sums array<double>"
    return trees.score(rows, nodes, [], work, {"label": F.col("label")}, out)


def _metric(scored: DataFrame, keys: list[str], metric: str) -> dict[tuple, float]:
    """Metric of every fit and form; the tables that are collected have a few rows for each."""
    if metric == "auc":
        positive = F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("pos")
        counts = scored.groupBy(*keys, "score").agg(F.sum("n").alias("n"), positive)
        return {tuple(r[k] for k in keys): r["auc"] for r in area_under_roc(None, "score", None, keys, counts).collect()}
    if metric in ("f1", "accuracy"):
        cells: dict[tuple, dict] = {}
        for r in scored.groupBy(*keys, "label", "score").agg(F.sum("n").alias("n")).collect():
            cells.setdefault(tuple(r[k] for k in keys), {})[r["label"], r["score"]] = r["n"]
        return {k: _accuracy(c) if metric == "accuracy" else _weighted_f1(c) for k, c in cells.items()}
    summed = scored.groupBy(*keys).agg(F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(5)]).alias("s"))
    out = {}
    for r in summed.collect():
        n, square, absolute, first, second = r["s"]
        spread = second / n - (first / n) ** 2
        found = {"mse": square / n, "rmse": (square / n) ** 0.5, "mae": absolute / n, "r2": 1 - square / n / spread if spread > 0 else float("nan")}
        out[tuple(r[k] for k in keys)] = found[metric]
    return out


def _accuracy(cells: dict) -> float:
    return sum(n for (y, p), n in cells.items() if y == p) / sum(cells.values())


def _weighted_f1(cells: dict) -> float:
    total, out = sum(cells.values()), 0.0
    for label in {y for y, _ in cells}:
        actual = sum(n for (y, _), n in cells.items() if y == label)
        called = sum(n for (_, p), n in cells.items() if p == label)
        out += actual / total * 2 * cells.get((label, label), 0) / (actual + called)
    return out


def cross_validate(train: DataFrame, learner, choices: dict[str, list], metric: str, fold: str, folds: int, width: int = 8) -> tuple[DataFrame, dict]:
    """(setting, params, metric) of every combination, by the mean over the folds, and the best one.

    ``choices`` are those of a tree or forest learner; ``maxDepth`` and ``numTrees`` are
    scored from shared fits.  ``metric`` is f1 (weighted), accuracy, auc, mse, rmse, mae or
    r2.  Rows hold label and features.  A class score is the mean class share of the
    trees' nodes.  Settings come in the order of the sorted names, the last varying fastest;
    of equal ones the first is best.
    """
    spark = train.sparkSession
    names = sorted(choices)
    depths = choices.get("maxDepth", [learner.getOrDefault("maxDepth")])
    has_trees = learner.hasParam("numTrees")
    sizes = choices.get("numTrees", [learner.getOrDefault("numTrees")]) if has_trees else [1]
    forms = [(d, t) for d in depths for t in sizes]
    others = [n for n in names if n not in ("maxDepth", "numTrees")]
    groups = [dict(zip(others, values)) for values in product(*[choices[n] for n in others])]
    held = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:

        def fit(group: dict, part: int):
            largest = {"maxDepth": max(depths)} | ({"numTrees": max(sizes)} if has_trees else {})
            own = learner.copy({learner.getParam(k): v for k, v in (group | largest).items()})
            return lambda: trees.nodes_of(spark, own.fit(held.where(F.col(fold) != part)))

        jobs = [(g, part) for g in range(len(groups)) for part in range(folds)]
        fitted = trees.side_by_side(spark, [fit(groups[g], part) for g, part in jobs], width)
        tables = [
            _scored(held.where(F.col(fold) == part), nodes, forms, metric).withColumns({"g": F.lit(g), "part": F.lit(part)})
            for (g, part), nodes in zip(jobs, fitted)
        ]
        found = _metric(reduce(DataFrame.union, tables), ["g", "part", "setting"], metric)
    finally:
        held.unpersist()
    rows = []
    for values in product(*[choices[n] for n in names]):
        params = dict(zip(names, values))
        g = groups.index({n: params[n] for n in others})
        at = forms.index((params.get("maxDepth", depths[0]), params.get("numTrees", sizes[0])))
        scores = [found[g, part, at] for part in range(folds) if found.get((g, part, at)) is not None]
        rows.append((params, float(np.mean(scores)) if scores else float("nan")))
    sign = 1 if metric in SMALLER_IS_BETTER else -1
    best = min(range(len(rows)), key=lambda i: (np.isnan(rows[i][1]), sign * rows[i][1], i))
    table = [(i, ", ".join(f"{k}={v}" for k, v in params.items()), value) for i, (params, value) in enumerate(rows)]
    return spark.createDataFrame(table, "setting int, params string, metric double"), rows[best][0]


def refit(train: DataFrame, learner, best: dict):
    """The learner at the best setting, fitted on all rows."""
    return learner.copy({learner.getParam(k): v for k, v in best.items()}).fit(train)

"""Kernel ridge regression on landmark rows.

The exact method solves an n x n system.  Here m landmark rows span the solution:
with every row a landmark the answer is the exact one, and with m fixed the work
grows with n only.  One pass gives the m x m moments of every (gamma, fold); all
penalties and folds of a grid are then solved from those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import few_tasks
from .joins import pick_landmarks


def kernel(x: np.ndarray, marks: np.ndarray, kind: str, gamma: float, coef0: float = 1.0, degree: int = 2) -> np.ndarray:
    if kind == "rbf":
        gap = (x * x).sum(1)[:, None] + (marks * marks).sum(1)[None, :] - 2 * x @ marks.T
        return np.exp(-gamma * np.clip(gap, 0, None))
    dot = x @ marks.T
    if kind == "linear":
        return dot
    if kind == "poly":
        return (coef0 + gamma * dot) ** degree
    if kind == "sigmoid":
        return np.tanh(gamma * dot + coef0)
    raise ValueError(f"unknown kernel {kind}")


def landmark_matrix(df: DataFrame, key: str, vector: str, m: int) -> np.ndarray:
    """``m`` rows (or all, when fewer), chosen by hash of the key."""
    rows = pick_landmarks(df, key, vector, m).collect()  # at most m rows
    return np.array([r[vector] for r in rows], float)


def _rows(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def fold_moments(
    df: DataFrame, vector: str, y: str, fold: str, marks: np.ndarray, kind: str, gammas: list[float]
) -> dict[tuple[int, int], dict]:
    """Per (gamma index, fold): n, sum of k k', k y and y^2 over the fold's rows.

    Each task adds up its own rows; the partial matrices are summed row by row in
    Spark (with combine before the shuffle) and only the sums reach the driver.
    """
    m = len(marks)
    data = df.select(
        F.col(vector).cast("array<double>").alias("x"),
        F.col(y).cast("double").alias("y"),
        F.col(fold).cast("int").alias("f"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            x, t = _rows(b, "x", marks.shape[1]), b.column("y").to_numpy(zero_copy_only=False)
            f = b.column("f").to_numpy(zero_copy_only=False)
            for g, gamma in enumerate(gammas):
                z = np.column_stack([kernel(x, marks, kind, gamma), t, np.ones(len(t))])
                for part in np.unique(f):
                    zp = z[f == part]
                    spot = (g, int(part))
                    sums[spot] = sums.get(spot, 0) + zp.T @ zp
        for (g, part), s in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(m + 2, g, np.int32)),
                    pa.array(np.full(m + 2, part, np.int32)),
                    pa.array(np.arange(m + 2, dtype=np.int32)),
                    pa.array(list(s), pa.list_(pa.float64())),
                ],
                names=["g", "f", "i", "v"],
            )

    parts = few_tasks(data).mapInArrow(run, "g int, f int, i int, v array<double>")
    summed = parts.groupBy("g", "f", "i").agg(Summarizer.sum(array_to_vector("v")).alias("s"))
    out: dict[tuple[int, int], np.ndarray] = {}
    for r in summed.select("g", "f", "i", vector_to_array("s").alias("v")).collect():
        out.setdefault((r["g"], r["f"]), np.zeros((m + 2, m + 2)))[r["i"]] = r["v"]
    return {
        k: {"n": s[-1, -1], "gram": s[:m, :m], "ky": s[:m, m], "yy": s[m, m]} for k, s in out.items()
    }


def add(parts: list[dict]) -> dict:
    return {k: sum(p[k] for p in parts) for k in ("n", "gram", "ky", "yy")}


def solve(moments: dict, base: np.ndarray, alpha: float, floor: float = 1e-12) -> np.ndarray:
    """Weights w of sum_j w_j K(landmark_j, x).

    Solved in the eigenbasis of the landmark kernel; directions under ``floor`` times
    the largest eigenvalue are beyond double precision and left out.
    """
    values, vectors = np.linalg.eigh((base + base.T) / 2)
    keep = values > floor * values.max()
    t = vectors[:, keep] / np.sqrt(values[keep])
    a = t.T @ moments["gram"] @ t
    return t @ np.linalg.lstsq(a + alpha * np.eye(len(a)), t.T @ moments["ky"], rcond=None)[0]


def rmse(moments: dict, w: np.ndarray) -> float:
    sse = moments["yy"] - 2 * w @ moments["ky"] + w @ moments["gram"] @ w
    return float(np.sqrt(max(sse, 0.0) / moments["n"]))


def fit(df: DataFrame, key: str, vector: str, y: str, alpha: float, gamma: float, kind: str = "rbf", m: int = 200):
    """(landmarks, weights) of one setting."""
    marks = landmark_matrix(df, key, vector, m)
    found = fold_moments(df.withColumn("_f", F.lit(0)), vector, y, "_f", marks, kind, [gamma])
    return marks, solve(found[(0, 0)], kernel(marks, marks, kind, gamma), alpha)


def predict(
    df: DataFrame, vector: str, marks: np.ndarray, weights: np.ndarray, gamma: float, kind: str = "rbf", out: str = "prediction"
) -> DataFrame:
    """Score rows in Arrow batches against the bounded set of landmarks."""
    schema = df.drop(out).schema.add(out, "double")
    spare = df.drop(out).withColumn("_x", F.col(vector).cast("array<double>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _rows(b, "_x", marks.shape[1])
            kept = b.drop_columns(["_x"])
            yield kept.append_column(out, pa.array(kernel(x, marks, kind, gamma) @ weights))

    return spare.mapInArrow(run, schema)


def grid_search(
    df: DataFrame,
    key: str,
    vector: str,
    y: str,
    fold: str,
    alphas: list[float],
    gammas: list[float],
    kind: str = "rbf",
    m: int = 200,
    rule: str = "mean",
) -> tuple[DataFrame, dict]:
    """Scores of every (alpha, gamma, fold) and the fitted winner.

    ``rule="best_fold"`` takes the setting of the smallest single fold; the default
    compares means over folds.  One pass over the data whatever the grid.
    """
    marks = landmark_matrix(df, key, vector, m)
    found = fold_moments(df, vector, y, fold, marks, kind, gammas)
    folds = sorted({f for _, f in found})
    rows = []
    for g, gamma in enumerate(gammas):
        base = kernel(marks, marks, kind, gamma)
        for f in folds:
            train = add([found[(g, o)] for o in folds if o != f])
            for alpha in alphas:
                rows.append((float(alpha), float(gamma), int(f), rmse(found[(g, f)], solve(train, base, alpha))))
    if rule == "best_fold":
        best = min(rows, key=lambda r: r[3])
    else:
        settings = sorted({r[:2] for r in rows})
        best = min(settings, key=lambda s: np.mean([r[3] for r in rows if r[:2] == s]))
    alpha, gamma = best[0], best[1]
    g = gammas.index(gamma)
    everything = add([found[(g, f)] for f in folds])
    weights = solve(everything, kernel(marks, marks, kind, gamma), alpha)
    table = df.sparkSession.createDataFrame(rows, "alpha double, gamma double, fold int, rmse double")
    return table, {"alpha": alpha, "gamma": gamma, "landmarks": marks, "weights": weights}

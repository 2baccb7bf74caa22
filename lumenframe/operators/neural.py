"""One-hidden-layer regressor trained by full-batch resilient backpropagation.

Weights are a few numbers; every step each task sums the gradient of its own rows
and Spark adds the partial sums, so the data never moves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import few_tasks


@dataclass
class Net:
    w1: np.ndarray  # (inputs + 1) x hidden, bias first
    w2: np.ndarray  # hidden + 1, bias first

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w1.ravel(), self.w2])

    def like(self, flat: np.ndarray) -> Net:
        cut = self.w1.size
        return Net(flat[:cut].reshape(self.w1.shape), flat[cut:])


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _gradient(net: Net, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    a = np.column_stack([np.ones(len(x)), x])
    h = np.tanh(a @ net.w1)
    b = np.column_stack([np.ones(len(x)), h])
    error = b @ net.w2 - y
    back = np.outer(error, net.w2[1:]) * (1 - h * h)
    return float(error @ error / 2), np.concatenate([(a.T @ back).ravel(), b.T @ error])


def fit(df: DataFrame, xs: list[str], y: str, hidden: int = 5, steps: int = 40, seed: int = 123) -> Net:
    """Train on scaled inputs; stops early once every partial derivative per row is below 1e-6."""
    k = len(xs)
    rng = np.random.default_rng(seed)
    net = Net(rng.normal(0, 0.5, (k + 1, hidden)), rng.normal(0, 0.5, hidden + 1))
    size = net.flat().size
    rows = df.select(
        F.array(*[F.col(c).cast("double") for c in xs]).alias("x"), F.col(y).cast("double").alias("y")
    )
    rows = few_tasks(rows.na.drop()).persist(StorageLevel.MEMORY_AND_DISK)

    def step_sums(net: Net) -> tuple[float, np.ndarray, int]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            loss, grad, n = 0.0, np.zeros(size), 0
            for b in batches:
                part, g = _gradient(net, _matrix(b, k), b.column("y").to_numpy(zero_copy_only=False))
                loss, grad, n = loss + part, grad + g, n + b.num_rows
            yield pa.RecordBatch.from_pydict(
                {"i": np.arange(size + 2, dtype=np.int32), "v": np.concatenate([grad, [loss, float(n)]])}
            )

        sums = rows.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
        v = np.zeros(size + 2)
        for r in sums:  # one number per weight
            v[r["i"]] = r["v"]
        return v[-2], v[:-2], int(v[-1])

    try:
        flat = net.flat()
        delta, before, last_step = np.full(size, 0.1), np.zeros(size), np.zeros(size)
        last_loss = np.inf
        best = (np.inf, flat.copy())
        for _ in range(steps):
            loss, grad, n = step_sums(net.like(flat))
            if n == 0:
                break
            if loss < best[0]:
                best = (loss, flat.copy())
            if np.abs(grad / n).max() < 1e-6:
                break
            same = np.sign(grad * before)
            delta = np.clip(np.where(same > 0, delta * 1.2, np.where(same < 0, delta * 0.5, delta)), 1e-8, 5.0)
            # After a sign change take the step back if the loss grew, and skip one update.
            undo = np.where((same < 0) & (loss > last_loss), -last_step, 0.0)
            move = np.where(same < 0, undo, -np.sign(grad) * delta)
            before = np.where(same < 0, 0.0, grad)
            last_step, last_loss = move, loss
            flat = flat + move
        return net.like(best[1])
    finally:
        rows.unpersist()


def predict(df: DataFrame, net: Net, xs: list[str], out: str = "prediction"):
    """Scoring is a column expression: no Python at all."""
    value = F.lit(float(net.w2[0]))
    for h in range(net.w1.shape[1]):
        z = F.lit(float(net.w1[0, h]))
        for i, c in enumerate(xs, start=1):
            z = z + F.lit(float(net.w1[i, h])) * F.col(c).cast("double")
        value = value + F.lit(float(net.w2[h + 1])) * F.tanh(z)
    return df.withColumn(out, value)

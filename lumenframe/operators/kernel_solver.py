"""Kernel ridge regression over all rows: conjugate gradients on (K + alpha I) w = y.

The n x n kernel is never held: a product with it is summed over pairs of row blocks, one
pair at a time.  The landmark solution is the preconditioner, so few products are needed.
Weights and residuals stay in the table of blocks, and only sums of a fixed size (m
numbers for m landmarks) reach the driver.  The work of a product grows with the square of
the rows, as the method has it.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage, spread
from .kernel_ridge import fold_moments, kernel, landmark_matrix

LOG = logging.getLogger(__name__)
# Rows of a block, and kernel values a task holds at once.
BLOCK_ROWS = 4096
VALUES = 1 << 21


def blocks(df: DataFrame, key: str, vector: str, **columns: Column) -> DataFrame:
    """One row per block of at most about ``BLOCK_ROWS`` rows: block, keys, x (all vectors in a row)
    and an array for each further column.  ``key`` must be unique; it alone decides the block."""
    count = max(1, -(-df.count() // BLOCK_ROWS))
    row = F.struct(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("x"), *[c.cast("double").alias(n) for n, c in columns.items()])
    packed = df.select(spread([F.col(key)], count).alias("block"), row.alias("row")).groupBy("block").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    return packed.select("block", F.col("rows.key").alias("keys"), F.flatten("rows.x").alias("x"), *[F.col(f"rows.{n}").alias(n) for n in columns])


def _mapped(table: DataFrame, width: int, work: Callable[[dict], dict], schema: str) -> DataFrame:
    """``work`` gets the columns of one block (x as a matrix) and gives those of one output row."""
    names = table.columns
    kinds = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                values = {n: b.column(n)[i] for n in names}
                row = {n: v.values.to_numpy(zero_copy_only=False) if isinstance(v, pa.ListScalar) and n != "keys" else v.as_py() for n, v in values.items()}
                for n in ("x", "x2"):
                    if n in row:
                        row[n] = row[n].reshape(-1, width)
                made = work(row)
                types = {"block": pa.int32(), "keys": b.schema.field("keys").type if "keys" in names else None}
                arrays = [pa.array([made[k]], types.get(k, pa.list_(pa.float64()))) for k in kinds]
                yield pa.RecordBatch.from_arrays(arrays, names=kinds)

    return table.mapInArrow(run, schema)


def product(points: DataFrame, sources: DataFrame, value: str, width: int, kind: str, gamma: float) -> DataFrame:
    """(block, q): sum over all source rows of kernel(point, source) * value, for every point.

    Every block of points meets every block of sources once; partial sums of a block
    combine before they are shuffled.
    """
    each = points.select("block", "x").withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(_blocks(sources) - 1))))
    right = sources.select(F.col("block").alias("other"), F.col("x").alias("x2"), F.col(value).alias("v"))

    def work(row: dict) -> dict:
        x, x2, v = row["x"], row["x2"], row["v"]
        step = max(1, VALUES // max(1, len(x2)))
        parts = [kernel(x[at : at + step], x2, kind, gamma) @ v for at in range(0, len(x), step)]
        return {"block": row["block"], "q": np.concatenate(parts).tolist()}

    partial = _mapped(each.join(right, "other").select("block", "x", "x2", "v"), width, work, "block int, q array<double>")
    return partial.groupBy("block").agg(Summarizer.sum(array_to_vector("q")).alias("s")).select("block", vector_to_array("s").alias("q"))


def _blocks(table: DataFrame) -> int:
    return (table.agg(F.max("block")).first()[0] or 0) + 1


def _sums(table: DataFrame, width: int, work: Callable[[dict], np.ndarray]) -> np.ndarray:
    """Sum of a vector of fixed length over all blocks."""
    parts = _mapped(table, width, lambda row: {"s": np.asarray(work(row), float).tolist()}, "s array<double>")
    return np.array(parts.agg(vector_to_array(Summarizer.sum(array_to_vector("s"))).alias("s")).first()["s"])


def solve(
    df: DataFrame, key: str, vector: str, y: str, alpha: float, gamma: float, kind: str = "rbf", m: int = 200,
    tolerance: float = 1e-10, max_steps: int = 200,
) -> tuple[DataFrame, dict]:
    """The blocks with their weights ``w``, and how the solver ended (steps, error, width).

    ``error`` is the norm of the residual over that of y.  A table without rows gives no
    blocks.  With every row a landmark one step is enough.
    """
    marks = landmark_matrix(df, key, vector, m)
    state = cut_lineage(blocks(df, key, vector, y=F.col(y)))
    if not len(marks):
        return state.withColumn("w", F.col("y")), {"steps": 0, "error": 0.0, "width": 1, "kind": kind, "gamma": gamma}
    width = marks.shape[1]
    base = kernel(marks, marks, kind, gamma)
    values, vectors = np.linalg.eigh((base + base.T) / 2)
    kept = values > 1e-12 * values.max()
    # Features of a row are kernel(row, landmarks) @ turn: their products approximate the kernel.
    turn = vectors[:, kept] / np.sqrt(values[kept])
    gram = fold_moments(df.withColumn("_f", F.lit(0)), vector, y, "_f", marks, kind, [gamma])[(0, 0)]["gram"]
    spectrum, axes = np.linalg.eigh(turn.T @ gram @ turn)
    shared = df.sparkSession.sparkContext.broadcast(marks)

    def landed(x: np.ndarray, values: np.ndarray) -> np.ndarray:
        return kernel(x, shared.value, kind, gamma).T @ values

    def correction(u: np.ndarray) -> np.ndarray:
        """Landmark weights c of the preconditioned residual (r - K c) / alpha."""
        return turn @ (axes @ ((axes.T @ (turn.T @ u)) / (np.maximum(spectrum, 0) + alpha)))

    def preconditioned(x: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (r - kernel(x, shared.value, kind, gamma) @ c) / alpha

    columns = "block int, keys {k}, x array<double>, y array<double>, w array<double>, r array<double>, p array<double>"
    schema = columns.format(k=f"array<{df.schema[key].dataType.simpleString()}>")
    first = _sums(state, width, lambda row: np.append(landed(row["x"], row["y"]), row["y"] @ row["y"]))
    c, target = correction(first[:-1]), first[-1]
    if not target:
        return state.withColumn("w", F.col("y")), {"steps": 0, "error": 0.0, "width": width, "kind": kind, "gamma": gamma}

    def begin(row: dict, c: np.ndarray = c) -> dict:
        p = preconditioned(row["x"], row["y"], c)
        return row | {"x": row["x"].ravel(), "w": np.zeros(len(p)), "r": row["y"], "p": p}

    state = cut_lineage(_mapped(state, width, begin, schema))
    rz = _sums(state, width, lambda row: [row["r"] @ row["p"]])[0]
    error, steps = 1.0, 0
    while error > tolerance and steps < max_steps:
        steps += 1
        q = product(state, state, "p", width, kind, gamma)
        ready = cut_lineage(state.join(q, "block").withColumn("q", F.zip_with("q", "p", lambda q, p: q + alpha * p)))
        found = _sums(ready, width, lambda row: np.concatenate([[row["p"] @ row["q"]], landed(row["x"], row["r"]), landed(row["x"], row["q"])]))
        size = rz / found[0]
        c = correction(found[1 : 1 + len(marks)] - size * found[1 + len(marks) :])

        def moved(row: dict, size: float = size, c: np.ndarray = c) -> tuple[np.ndarray, np.ndarray]:
            r = row["r"] - size * row["q"]
            return r, preconditioned(row["x"], r, c)

        def ends(row: dict, moved: Callable = moved) -> list[float]:
            r, z = moved(row)
            return [r @ r, r @ z]

        rr, new = _sums(ready, width, ends)

        def advance(row: dict, size: float = size, share: float = new / rz, moved: Callable = moved) -> dict:
            r, z = moved(row)
            out = row | {"x": row["x"].ravel(), "w": row["w"] + size * row["p"], "r": r, "p": z + share * row["p"]}
            del out["q"]
            return out

        state, rz, error = cut_lineage(_mapped(ready, width, advance, schema)), new, float(np.sqrt(rr / target))
    if error > tolerance:
        LOG.warning("kernel ridge: a residual of %.2g is left after %d steps", error, steps)
    return state.select("block", "keys", "x", "w"), {"steps": steps, "error": error, "width": width, "kind": kind, "gamma": gamma}


def weights(solution: DataFrame) -> DataFrame:
    """(key, weight) of every training row."""
    return solution.select(F.explode(F.arrays_zip(F.col("keys").alias("key"), F.col("w").alias("weight"))).alias("r")).select("r.*")


def predict(df: DataFrame, key: str, vector: str, solution: DataFrame, about: dict) -> DataFrame:
    """(key, prediction) of every row of ``df``, whose ``key`` must be unique."""
    points = cut_lineage(blocks(df, key, vector))
    found = product(points, solution, "w", about["width"], about["kind"], about["gamma"])
    both = points.select("block", "keys").join(found, "block")
    return both.select(F.explode(F.arrays_zip(F.col("keys").alias("key"), F.col("q").alias("prediction"))).alias("r")).select(F.col("r.key").alias(key), "r.prediction")

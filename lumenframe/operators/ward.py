"""Agglomerative merging of subclusters by Ward's criterion, in rounds.

In every round each cluster finds its nearest one, and all pairs that are each other's
nearest merge.  Ward's distance never falls below that of the merged parts, so the merges
are those of the greedy method, only found many at a time; cutting the sorted merges gives
the same clusters.  Clusters meet in pairs of blocks and only the nearest of each is kept,
so no table of pairs is ever written.  When at most ``LOCAL`` are left, a bounded number,
the rest is merged in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import cut_lineage, lookup, spread

# Clusters that are merged in memory, and clusters of a block before.
LOCAL = 4096
BLOCK = 4096
PAIRS = 1 << 21
MERGE = "kept bigint, gone bigint, cost double"


def ward_cost(n: np.ndarray, x: np.ndarray, m: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Growth of the sum of squares when clusters of n at x join those of m at z."""
    gap = (x * x).sum(1)[:, None] + (z * z).sum(1)[None, :] - 2 * x @ z.T
    return np.maximum(gap, 0.0) * (n[:, None] * m[None, :] / (n[:, None] + m[None, :]))


def _nearest(n: np.ndarray, x: np.ndarray, ids: np.ndarray, m: np.ndarray, z: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, cost) of the nearest other cluster; of equally near ones the smaller id."""
    best, cost = np.full(len(n), -1, np.int64), np.full(len(n), np.inf)
    order = np.argsort(others, kind="stable")
    m, z, others = m[order], z[order], others[order]
    step = max(1, PAIRS // max(1, len(m)))
    for at in range(0, len(n), step):
        found = ward_cost(n[at : at + step], x[at : at + step], m, z)
        found[ids[at : at + step][:, None] == others[None, :]] = np.inf
        first = found.argmin(axis=1)
        cost[at : at + step] = found[np.arange(len(first)), first]
        best[at : at + step] = others[first]
    best[~np.isfinite(cost)] = -1
    return best, cost


def merge_in_memory(ids: np.ndarray, n: np.ndarray, x: np.ndarray) -> list[tuple[int, int, float]]:
    """(kept, gone, cost) of all merges down to one cluster; the smaller id stays."""
    ids, n, x = ids.copy(), n.astype(float).copy(), x.astype(float).copy()
    out = []
    while len(ids) > 1:
        near, cost = _nearest(n, x, ids, n, x, ids)
        place = {int(i): k for k, i in enumerate(ids)}
        pairs = [(k, place[int(b)]) for k, b in enumerate(near) if b > ids[k] and near[place[int(b)]] == ids[k]]
        gone = np.zeros(len(ids), bool)
        for a, b in pairs:
            out.append((int(ids[a]), int(ids[b]), float(cost[a])))
            x[a] = (n[a] * x[a] + n[b] * x[b]) / (n[a] + n[b])
            n[a] += n[b]
            gone[b] = True
        if not pairs:  # only equal costs in a circle could come here; the nearest of all merges
            a = int(cost.argmin())
            b = place[int(near[a])]
            a, b = (a, b) if ids[a] < ids[b] else (b, a)
            out.append((int(ids[a]), int(ids[b]), float(cost.min())))
            x[a] = (n[a] * x[a] + n[b] * x[b]) / (n[a] + n[b])
            n[a] += n[b]
            gone[b] = True
        ids, n, x = ids[~gone], n[~gone], x[~gone]
    return out


def _matrix(batch: pa.RecordBatch, name: str, width: int, row: int) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy(zero_copy_only=False).reshape(-1, width)


def _neighbours(clusters: DataFrame, width: int, count: int) -> DataFrame:
    """(id, near, cost): the nearest of every cluster, by blocks against blocks."""
    blocks = max(1, -(-count // BLOCK))
    packed = clusters.groupBy(spread([F.col("id")], blocks).alias("block")).agg(F.sort_array(F.collect_list(F.struct("id", "n", "x"))).alias("r"))
    packed = cut_lineage(packed.select("block", F.col("r.id").alias("ids"), F.col("r.n").alias("n"), F.flatten("r.x").alias("x")))
    right = packed.select(F.col("block").alias("other"), F.col("ids").alias("ids2"), F.col("n").alias("n2"), F.col("x").alias("x2"))
    met = packed.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(right, "other").drop("block", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids, n, ids2, n2 = (b.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("ids", "n", "ids2", "n2"))
                near, cost = _nearest(n, _matrix(b, "x", width, i), ids, n2, _matrix(b, "x2", width, i), ids2)
                held = np.isfinite(cost)
                yield pa.RecordBatch.from_arrays([pa.array(ids[held]), pa.array(near[held]), pa.array(cost[held])], names=["id", "near", "cost"])

    found = met.mapInArrow(run, "id bigint, near bigint, cost double")
    best = found.groupBy("id").agg(F.min(F.struct("cost", "near")).alias("b"))
    return best.select("id", F.col("b.near").alias("near"), F.col("b.cost").alias("cost"))


def merges(cells: DataFrame, columns: list[str], weight: str = "n") -> tuple[DataFrame, DataFrame]:
    """The cells with an ``id``, and (kept, gone, cost) of every merge down to one cluster.

    Ids follow the order of a hash of the cell's columns; cells that are equal in them
    must not stand twice.
    """
    spark, width = cells.sparkSession, len(columns)
    # Distinct cells have distinct hashes but for accidents, which the order by columns tells apart.
    code = F.xxhash64(*[F.col(c) for c in columns])
    numbered = cells.withColumn("id", code)
    twice = F.row_number().over(Window.partitionBy("id").orderBy(*columns)) - 1
    named = cut_lineage(numbered.withColumn("id", F.col("id") + twice))
    point = F.array(*[F.col(c).cast("double") for c in columns])
    left = cut_lineage(named.select("id", F.col(weight).cast("double").alias("n"), point.alias("x")))
    count, steps = left.count(), []
    while count > LOCAL:
        near = cut_lineage(_neighbours(left, width, count))
        back = near.select(F.col("id").alias("near"), F.col("near").alias("id"), F.col("cost").alias("again"))
        pairs = cut_lineage(near.join(back, ["id", "near"]).where("id < near").select(F.col("id").alias("kept"), F.col("near").alias("gone"), "cost"))
        steps.append(pairs)
        kept = lookup(left.withColumn("gone", F.col("id")), pairs.select("gone", "kept"), ["gone"], "left")
        grouped = kept.groupBy(F.coalesce("kept", "id").alias("id")).agg(
            F.sum("n").alias("n"), *[F.sum(F.col("n") * F.get("x", F.lit(i))).alias(f"s{i}") for i in range(width)]
        )
        left = cut_lineage(grouped.select("id", "n", F.array(*[F.col(f"s{i}") / F.col("n") for i in range(width)]).alias("x")))
        now = left.count()
        if now == count:
            raise ValueError("no two clusters are each other's nearest")
        count = now
    rest = left.orderBy("id").collect()  # at most LOCAL rows
    last = merge_in_memory(np.array([r["id"] for r in rest], np.int64), np.array([r["n"] for r in rest]), np.array([r["x"] for r in rest], float).reshape(-1, width))
    found = spark.createDataFrame(last, MERGE)
    for pairs in steps:
        found = found.union(pairs)
    return named, cut_lineage(found)


def clusters(cells: DataFrame, columns: list[str], k: int, weight: str = "n") -> DataFrame:
    """The cells with ``cluster``, the smallest id of its cells, in at most ``k`` clusters.

    All merges but the k - 1 costliest are carried out; of equal ones those of larger ids
    are left out first.
    """
    named, steps = merges(cells, columns, weight)
    dear = steps.orderBy(F.desc("cost"), F.desc("kept"), F.desc("gone")).limit(max(k - 1, 0))
    done = steps.join(F.broadcast(dear.select("kept", "gone")), ["kept", "gone"], "left_anti")
    # Follow each cell to what it ends in: paths halve in every round.
    up = cut_lineage(done.select(F.col("gone").alias("id"), F.col("kept").alias("top")))
    while True:
        above = up.select(F.col("id").alias("top"), F.col("top").alias("higher"))
        moved = lookup(up, above, ["top"], "left")
        if not moved.where("higher is not null").limit(1).count():
            break
        up = cut_lineage(moved.select("id", F.coalesce("higher", "top").alias("top")))
    ended = lookup(named, up, ["id"], "left")
    return ended.withColumn("cluster", F.coalesce("top", "id")).drop("top", "id")

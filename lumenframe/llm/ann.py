"""Nearest neighbours by cosine: probed lists, rotated vectors in column blocks, early abandoning."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import cut_lineage

# Vectors per list aimed at, most lists, and rows the lists are fitted on.
LIST_ROWS = 512
MAX_LISTS = 4096
SAMPLE = 16_384
# Share of the sample's true neighbours that the probed lists must hold.
RECALL = 0.98
# Candidates and queries of one unit of work; a crowded list is cut into several.
PART_ROWS = 4096
PART_QUERIES = 2048
# Columns scanned between tests, and how many deviations a test allows.
COLUMNS = 16
EPSILON = 2.1
# Candidates in a step, between which the distance to beat is lowered.
STEP = 1024


@dataclass
class Lists:
    """Centroids of unit vectors, how many lists to probe, and the rotation."""

    centroids: np.ndarray
    probes: int
    rotation: np.ndarray

    def order(self, unit: np.ndarray) -> np.ndarray:
        """Lists of each vector, nearest first, as many as are probed."""
        near = -(unit @ self.centroids.T)
        if self.probes < near.shape[1]:
            some = np.argpartition(near, self.probes - 1, axis=1)[:, : self.probes]
            ranked = np.argsort(np.take_along_axis(near, some, 1), axis=1, kind="stable")
            return np.take_along_axis(some, ranked, 1)
        return np.argsort(near, axis=1, kind="stable")

    def reach(self, unit: np.ndarray, held: np.ndarray, least: int) -> list[list[int]]:
        """Probed lists of each vector, and the next nearest ones while those hold fewer than ``least`` candidates."""
        probed = self.order(unit)
        out = probed.tolist()
        for i in np.flatnonzero(held[probed].sum(axis=1) < least):
            every = np.argsort(-(self.centroids @ unit[i]), kind="stable")
            out[i] = every[: np.searchsorted(held[every].cumsum(), least) + 1].tolist()
        return out


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Array column without nulls, all of one length, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def fit(sample: np.ndarray, rows: int, dims: int, k: int) -> Lists:
    """Lists for ``rows`` vectors from a bounded sample of distinct ones.

    The number of probed lists is the least that holds the share ``RECALL`` of the k
    nearest neighbours, within the sample, of up to 256 of its vectors.
    """
    rng = np.random.default_rng(11)
    rotation, _ = np.linalg.qr(rng.standard_normal((dims, dims)))
    unit = _unit(sample) if len(sample) else np.zeros((0, dims))
    wanted = max(1, min(-(-rows // LIST_ROWS), MAX_LISTS, len(unit) // 8))
    if not len(unit):
        return Lists(np.zeros((1, dims)), 1, rotation)
    centroids = unit[rng.choice(len(unit), wanted, replace=False)]
    for _ in range(12):
        mine = (unit @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, mine, unit)
        held = (sums != 0).any(axis=1)
        centroids = np.where(held[:, None], sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12), centroids)
    lists = Lists(centroids, wanted, rotation)
    mine = (unit @ centroids.T).argmax(axis=1)
    asked = rng.choice(len(unit), min(256, len(unit)), replace=False)
    cosine = unit[asked] @ unit.T
    cosine[np.arange(len(asked)), asked] = -np.inf
    near = np.argsort(-cosine, axis=1, kind="stable")[:, : min(k, len(unit) - 1)]
    if near.size:
        rank = np.argsort(lists.order(unit[asked]), axis=1, kind="stable")
        needed = np.sort(np.take_along_axis(rank, mine[near], 1).ravel())
        lists.probes = int(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))) - 1)]) + 1
    return lists


def scan(query: np.ndarray, blocks: list[np.ndarray], k: int) -> np.ndarray:
    """Candidates that may be among the k nearest to a rotated unit vector.

    ``blocks`` are the candidates by column block.  After each block the squared distance
    so far, scaled to all columns, is an estimate of the whole; a candidate is abandoned
    when it passes the k-th distance found so far by more than chance allows.
    """
    n, dims = len(blocks[0]), len(query)
    best_at, best = np.zeros(0, np.int64), np.zeros(0)
    limit, at, step = np.inf, 0, 4 * k
    while at < n:
        index = np.arange(at, min(n, at + step))
        at, step = at + step, STEP
        total, seen = np.zeros(len(index)), 0
        for block in blocks:
            width = block.shape[1]
            apart = block[index] - query[seen : seen + width]
            total = total + np.einsum("ij,ij->i", apart, apart)
            seen += width
            if seen < dims and limit < np.inf:
                stay = total * (dims / seen) <= limit * (1 + EPSILON / np.sqrt(seen)) ** 2 + 1e-9
                index, total = index[stay], total[stay]
        best_at, best = np.concatenate([best_at, index]), np.concatenate([best, total])
        if len(best) > k:
            limit = np.partition(best, k - 1)[k - 1]
            # Near ties stay, to be told apart by the exact measure.
            stay = best <= limit + 1e-6
            best_at, best = best_at[stay], best[stay]
    return best_at


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine in double precision; components are scaled first, so none overflows."""
    query, rows = query / np.abs(query).max(), rows / np.abs(rows).max(axis=1, keepdims=True)
    return (rows * query).sum(axis=1) / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum()))


def _search(key: tuple, left: pa.Table, right: pa.Table, lists: Lists, k: int) -> pa.Table:
    """The k best ids for every query of a unit of work among its candidates."""
    out: dict[str, list] = {"k1": [], "k2": [], "vec_id": [], "score": []}
    if left.num_rows and right.num_rows:
        rows, ids = _matrix(left.column("vector")), left.column("ids").to_pylist()
        turned = (_unit(rows) @ lists.rotation).astype(np.float32)
        blocks = [np.ascontiguousarray(turned[:, c : c + COLUMNS]) for c in range(0, turned.shape[1], COLUMNS)]
        asked = _matrix(right.column("asked"))
        turned = (_unit(asked) @ lists.rotation).astype(np.float32)
        for q, (a, b) in enumerate(zip(right.column("k1").to_pylist(), right.column("k2").to_pylist())):
            near = scan(turned[q], blocks, k)
            scores = cosines(asked[q], rows[near])
            found = sorted((-s, i) for s, r in zip(scores.tolist(), near.tolist()) for i in ids[r])[:k]
            out["k1"] += [a] * len(found)
            out["k2"] += [b] * len(found)
            out["vec_id"] += [i for _, i in found]
            out["score"] += [-s for s, _ in found]
    kinds = {"k1": pa.int64(), "k2": pa.int64(), "vec_id": left.schema.field("ids").type.value_type, "score": pa.float64()}
    return pa.table({c: pa.array(v, kinds[c]) for c, v in out.items()})


def _valid(table: DataFrame, vec_id: str, vector: str) -> DataFrame:
    column = F.col(vector).cast("array<double>")
    rows = table.select(F.col(vec_id).alias("vec_id"), column.alias("vector")).where("vec_id is not null and vector is not null")
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~bad & F.exists("vector", lambda x: x != 0))
    return rows.withColumns({"k1": F.xxhash64("vector"), "k2": F.xxhash64("vector", F.lit(1))})


def nearest(table: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows by cosine, for every query row.

    ``is_query`` is a condition on ``vec_id``.  Candidates are all rows but those with the
    query's own id; ties go to the smaller id.  Equal vectors are searched once, as query
    and as candidate, with their k + 1 smallest ids, so a vector that a third of all rows
    share costs as much as any other.  Every row is in a list; crowded lists are cut into
    units of bounded size, each joined with each share of the queries that probe the list.
    Where the probed lists hold fewer than k candidates, the query probes on until they do
    or no list is left, so only a table of fewer candidates gives fewer than k rows.

    Rows whose id or vector is null, whose vector is zero, empty or holds null or
    non-finite components, or has another length than most, take no part.  Repeated rows
    count once.  An empty table, or one without queries, gives an empty result.
    """
    rows = _valid(table, vec_id, vector)
    lengths = rows.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    dims = lengths[0]["dims"] if lengths else 1
    rows = rows.where(F.size("vector") == dims).withColumn("asks", F.coalesce(is_query, F.lit(False)))
    least = Window.partitionBy("k1", "k2", "asks").orderBy("vec_id")
    few = rows.withColumn("place", F.dense_rank().over(least)).where(F.col("place") <= k + 1)
    ids = F.slice(F.sort_array(F.collect_set("vec_id")), 1, k + 1)
    classes = cut_lineage(few.groupBy("k1", "k2").agg(F.first("vector").alias("vector"), ids.alias("ids"), F.max("asks").alias("asks")))

    n = classes.count()
    picked = classes.where(F.pmod("k1", F.lit(max(1, n // SAMPLE))) == 0).orderBy("k1", "k2").limit(2 * SAMPLE)
    lists = fit(_matrix(picked.select("vector").toArrow().column(0)) if n else np.zeros((0, dims)), n, dims, k)
    spark = table.sparkSession
    shared = spark.sparkContext.broadcast(lists)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = shared.value.order(_unit(_matrix(batch.column("vector"))))
            kept = ["k1", "k2", "vector", "ids", "asks"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(order[:, 0], pa.int32())], names=[*kept, "list"])

    kind = table.schema[vec_id].dataType.simpleString()
    assigned = cut_lineage(
        classes.mapInArrow(assign, f"k1 bigint, k2 bigint, vector array<double>, ids array<{kind}>, asks boolean, list int")
    )
    # One row per list: at most MAX_LISTS, so both sides of the plan below may broadcast them.
    parts = F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int")
    sizes = cut_lineage(assigned.groupBy("list").agg(parts.alias("parts"), F.sum(F.size("ids")).alias("held")))
    held = np.zeros(len(lists.centroids), np.int64)
    for row in sizes.collect():
        held[row["list"]] = row["held"]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            # One candidate more than asked for, as the query itself is in a list.
            probes = shared.value.reach(_unit(_matrix(batch.column("vector"))), held, k + 1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("k1", "k2", "vector")), pa.array(probes, pa.list_(pa.int32()))],
                names=["k1", "k2", "vector", "probes"],
            )

    probing = assigned.where("asks").select("k1", "k2", "vector")
    probing = cut_lineage(probing.mapInArrow(probe, "k1 bigint, k2 bigint, vector array<double>, probes array<int>"))
    asked = probing.select("k1", "k2", "vector", F.explode("probes").alias("list"))
    loads = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PART_QUERIES).cast("int").alias("shares"))
    units = spark.createDataFrame(sizes.drop("held").join(loads, "list").toPandas().astype("int32"), "list int, parts int, shares int")
    units = F.broadcast(units)

    def spread(of: str) -> Column:
        return F.pmod(F.xxhash64("k1", "k2", F.lit(2)), F.col(of)).cast("int")

    def all_of(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    cell = ["list", "part", "share"]
    candidates = assigned.join(units, "list").withColumn("part", spread("parts")).withColumn("share", all_of("shares"))
    queries = asked.join(units, "list").withColumn("share", spread("shares")).withColumn("part", all_of("parts"))
    pairs = candidates.select(*cell, "vector", "ids").groupBy(*cell).cogroup(queries.select(*cell, "k1", "k2", F.col("vector").alias("asked")).groupBy(*cell))
    found = pairs.applyInArrow(
        lambda key, left, right: _search(key, left, right, shared.value, k + 1), f"k1 bigint, k2 bigint, vec_id {kind}, score double"
    )
    best = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    found = found.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near"))
    asking = rows.where("asks").select(F.col("vec_id").alias("query_id"), "k1", "k2").distinct()
    others = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    named = asking.join(found, ["k1", "k2"]).select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "near"))
    return named.select("query_id", (F.col("at") + 1).alias("rank"), "near.vec_id", "near.score")

"""Hard negatives by slot-decomposed selection over exact integer inner products.

The upper limits of an anchor's positives cut the scores into disjoint slots.  Every
unit of work keeps the best few rows of each slot; merged over all units and read from a
positive's own slot downwards, they are the best rows under its limit, so all windows of
an anchor, though they overlap, are answered from one short list.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import cut_lineage, spread

# Most rows and anchors of one unit of work, fewest rows worth one, and scores held at once inside it.
PART_ROWS = 65_536
PART_ANCHORS = 16_384
FEW_ROWS = 2048
SCORES = 1 << 20
LONG = 2**63 - 1

# Scores of all rows of a unit, which may count, which share the anchor's label, the anchor's limits: slots and places.
Pick = Callable[[np.ndarray, np.ndarray, np.ndarray, tuple], list[tuple[int, np.ndarray]]]


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), dims)


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer inner products of whole numbers; beyond a long they end at its limits.

    Where every partial sum stays under 2^53 a product in double precision is exact; rows
    with larger components are multiplied as whole numbers of any length.
    """
    safe = np.sqrt(2.0**53 / max(left.shape[1], 1))
    plain_left = np.abs(left).max(axis=1, initial=0) <= safe
    plain_right = np.abs(right).max(axis=1, initial=0) <= safe
    if plain_left.all() and plain_right.all():
        return (left @ right.T).astype(np.int64)
    out = np.zeros((len(left), len(right)), np.int64)
    out[np.ix_(plain_left, plain_right)] = left[plain_left] @ right[plain_right].T
    whole = np.vectorize(int, otypes=[object])

    def fill(rows: np.ndarray, columns: np.ndarray) -> None:
        if len(rows) and len(columns):
            sums = whole(left[rows]) @ whole(right[columns]).T
            out[np.ix_(rows, columns)] = np.clip(sums, -LONG, LONG).astype(np.int64)

    fill(np.flatnonzero(~plain_left), np.arange(len(right)))
    fill(np.flatnonzero(plain_left), np.flatnonzero(~plain_right))
    return out


def largest(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, best first; of equal ones the earlier place."""
    places = np.arange(len(scores))
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > edge)
        places = np.concatenate([above, np.flatnonzero(scores == edge)[: k - len(above)]])
    return places[np.lexsort((places, -scores[places]))]


def best_same(k: int) -> Pick:
    """The best k other rows of the anchor's label."""

    def pick(scores: np.ndarray, other: np.ndarray, same: np.ndarray, _) -> list[tuple[int, np.ndarray]]:
        places = np.flatnonzero(other & same)
        return [(0, places[largest(scores[places], k)])]

    return pick


def best_by_slot(k: int) -> Pick:
    """The best k rows of other labels in every slot: above limit i + 1, not above limit i."""

    def pick(scores: np.ndarray, other: np.ndarray, same: np.ndarray, limits: tuple) -> list[tuple[int, np.ndarray]]:
        rising, lower = np.asarray(limits[0][::-1], np.int64), limits[1]
        places = np.flatnonzero(other & ~same & (scores <= rising[-1]) & (scores >= lower))
        slots = len(rising) - 1 - np.searchsorted(rising, scores[places], side="left")
        inside = [(slot, places[slots == slot]) for slot in np.unique(slots).tolist()]
        return [(slot, where[largest(scores[where], k)]) for slot, where in inside]

    return pick


def _unit(dims: int, left: pa.Table, right: pa.Table, pick: Pick) -> pa.Table:
    """(anchor_id, slot, score, vec_id) of what is kept of a unit's rows for each of its anchors."""
    found: dict[str, list] = {"anchor_id": [], "slot": [], "score": [], "vec_id": []}
    if left.num_rows and right.num_rows:
        # In the order of their ids, nulls last, the places of rows break ties.
        left = left.sort_by([("vec_id", "ascending")])
        row_ids, anchor_ids = left.column("vec_id").combine_chunks(), right.column("anchor_id").combine_chunks()
        rows, labels = _matrix(left.column("vector"), dims), left.column("label").to_numpy()
        asked, own = _matrix(right.column("asked"), dims), right.column("own").to_numpy()
        limits = list(zip(right.column("uppers").to_pylist(), right.column("lower").to_pylist()))
        step = max(1, SCORES // len(rows))
        for start in range(0, len(asked), step):
            for a, scores in enumerate(inner_products(asked[start : start + step], rows), start):
                other = pc.fill_null(pc.not_equal(row_ids, anchor_ids[a]), True).to_numpy(zero_copy_only=False)
                for slot, places in pick(scores, other, labels == own[a], limits[a]):
                    found["anchor_id"].append(np.full(len(places), a))
                    found["slot"].append(np.full(len(places), slot, np.int32))
                    found["score"].append(scores[places])
                    found["vec_id"].append(places)
    joined = {c: pa.array(np.concatenate(v) if v else [], pa.int32() if c == "slot" else pa.int64()) for c, v in found.items()}
    if len(joined["score"]):
        joined |= {"anchor_id": anchor_ids.take(joined["anchor_id"]), "vec_id": row_ids.take(joined["vec_id"])}
    ids = left.schema.field("vec_id").type
    kinds = {"anchor_id": ids, "vec_id": ids}
    return pa.table({c: v.cast(kinds.get(c, v.type)) for c, v in joined.items()})


def whole_parts(vector: Column, scale: int = 256) -> Column:
    """Each component times ``scale``, rounded down, as doubles that hold whole numbers."""
    scaled = F.transform(vector.cast("array<double>"), lambda x: x * scale)
    # A double of 2^53 or more has no fraction, and floor() would leave the range of a long.
    return F.transform(scaled, lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x))


def valid_rows(table: DataFrame, is_anchor: Column, label: Column, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, label, vector, dims, asks) of the rows that take part, each once."""
    rows = table.select(
        F.col(f"`{vec_id}`").alias("vec_id"), label.cast("long").alias("label"), whole_parts(F.col(f"`{vector}`")).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    )
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where("label is not null and vector is not null").where(~bad).withColumn("dims", F.size("vector")).distinct()


def share_of(score: Column, percent: int, up: bool) -> Column:
    """score * percent / 100 for scores from 0 and up to 100 percent, rounded up or down, within the range of a long."""
    rest = percent * (score % 100) + (99 if up else 0)
    return percent * F.call_function("div", score, F.lit(100)) + F.call_function("div", rest, F.lit(100))


def _best(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best rows of each key; Spark keeps the k best of each task before it shuffles."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def mine(
    table: DataFrame, is_anchor: Column, label: Column, vec_id: str = "vec_id", vector: str = "embedding",
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    A score is the integer inner product with the anchor of the components times 256,
    rounded down.  An anchor's positives are its best ``positives`` other rows of its
    label.  For each of them come the best ``negatives`` rows of other labels whose score
    lies between ``low`` and ``high`` percent of the positive's, best first, ties to the
    smaller id.  ``is_anchor`` is a condition on, and ``label`` an expression of, the
    table's columns.

    All anchors meet all rows in units of bounded size: rows are dealt by a hash of their
    content, so neither a label nor a vector that a third of all rows share makes a large
    unit.  Every unit passes on at most ``positives``, or ``negatives`` per slot, rows for
    an anchor, and Spark cuts these down again before it shuffles them.

    Rows with a null label or vector, or a null or non-finite component (also after the
    scaling), take no part.  Repeated rows count once.  Rows that share an id but differ
    are separate rows, never compared with an anchor of that id; of such anchors the
    least by label and vector is taken.  A null id is no anchor and comes last in ties.
    Vectors are compared with those of their length only; empty vectors score 0.  Scores
    beyond a long stand at its limit.  An anchor without positives of score 0 or more, or
    without rows in their windows, gives no row; no anchors or an empty table give an
    empty result.
    """
    if not 0 <= low <= high <= 100:
        raise ValueError("low and high must be percentages, low not above high")
    kind = table.schema[vec_id].dataType.simpleString()
    rows = cut_lineage(valid_rows(table, is_anchor, label, vec_id, vector))
    anchors = rows.where("asks and vec_id is not null").groupBy("vec_id").agg(F.min(F.struct("label", "vector", "dims")).alias("x"))
    anchors = cut_lineage(anchors.select(F.col("vec_id").alias("anchor_id"), F.col("x.label").alias("own"), F.col("x.vector").alias("asked"), "x.dims"))
    n, m = rows.count(), anchors.count()
    few = max(1, min(2 * table.sparkSession.sparkContext.defaultParallelism, n // FEW_ROWS))
    parts, shares = max(few, -(-n // PART_ROWS)), max(1, -(-m // PART_ANCHORS))

    def meet(asking: DataFrame, pick: Pick) -> DataFrame:
        """Every anchor with every row of its length, unit by unit."""
        cell = ["dims", "part", "share"]

        def every(count: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

        left = rows.select("dims", "vec_id", "label", "vector", spread([F.col(c) for c in ("vec_id", "label", "vector")], parts).alias("part"), every(shares).alias("share"))
        right = asking.select("*", spread([F.col("anchor_id")], shares).alias("share"), every(parts).alias("part"))
        pairs = left.groupBy(*cell).cogroup(right.groupBy(*cell))
        return pairs.applyInArrow(
            lambda key, a, b: _unit(key[0].as_py(), a, b, pick), f"anchor_id {kind}, slot int, score bigint, vec_id {kind}"
        )

    bare = anchors.withColumns({"uppers": F.array().cast("array<bigint>"), "lower": F.lit(0).cast("bigint")})
    near = _best(meet(bare, best_same(positives)), ["anchor_id"], positives)
    near = near.withColumns({"upper": share_of(F.col("score"), high, False), "lower": share_of(F.col("score"), low, True)})
    # A negative score has no window: the one limit lies above the other.
    near = cut_lineage(near.where("score >= 0"))
    limits = near.groupBy("anchor_id").agg(F.reverse(F.array_sort(F.collect_set("upper"))).alias("uppers"), F.min("lower").alias("lower"))
    kept = _best(meet(anchors.join(limits, "anchor_id"), best_by_slot(negatives)), ["anchor_id", "slot"], negatives)
    # In the order of slots, then of scores, this is the merge of all slots; at most `negatives` rows of each.
    row = F.struct("slot", (-F.col("score")).alias("down"), F.col("vec_id").isNull().alias("last"), "vec_id")
    merged = kept.groupBy("anchor_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    asked = near.join(limits.drop("lower"), "anchor_id").join(merged, "anchor_id")
    slot = F.array_position("uppers", F.col("upper")) - 1
    below = F.slice(F.filter("rows", lambda x: x["slot"] >= slot), 1, negatives)
    found = asked.withColumn("found", F.filter(below, lambda x: -x["down"] >= F.col("lower")))
    named = found.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.posexplode("found").alias("at", "x"))
    return named.select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("negative_id"), "positive_score",
        (-F.col("x.down")).alias("negative_score"),
    )

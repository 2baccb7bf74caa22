"""Near-duplicate documents by SimHash fingerprints, compared on vertical bit planes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage, lookup
from .common import blank_words, byte_texts, carried, ddl
from .components import roots

BITS = 64
SEED = 42
# Most fingerprints compared with each other in one go, and members of a part of a crowded bucket.
TILE = 512
CROWD = 4096
# Shingles whose bits are unpacked at once.
STRIP = 1 << 15
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(data: bytes | None, width: int = 3) -> int:
    """SimHash of the word shingles of a text, as a signed 64-bit number."""
    words = blank_words(data)
    if not words:
        return 0
    line = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    if len(words) < width:
        starts, width = [0, starts[-1]], 1
    n = len(starts) - width
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a : b - 1], SEED) for a, b in zip(starts, starts[width:])), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, STRIP):
        octets = hashes[at : at + STRIP].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, doc_id: str, text: str, width: int = 3, extra: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, fp) per row, and what ``extra`` names; a null or wordless text has fingerprint 0."""
    columns = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"), *[c.alias(n) for n, c in (extra or {}).items()])
    keep = [c for c in columns.columns if c != "_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, width) for t in byte_texts(batch.column("_text"))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(prints, pa.int64())], names=[*keep, "fp"])

    return columns.mapInArrow(run, f"{ddl(columns.select(*keep))}, fp bigint")


def close_pairs(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of fingerprints that differ in at most ``radius`` bits.

    Candidates are stored as bit planes: word w of plane p holds bit p of candidates 64w to
    64w + 63, so one operation compares a bit of a query with 64 candidates.  Differences
    are added into carry-save counters.  A block of 64 is given up once all have passed
    the radius.
    """
    n = len(prints)
    words = -(-n // 64)
    bits = np.unpackbits(prints.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    padded = np.zeros((words * 64, BITS), np.uint8)
    padded[:n] = bits
    planes = np.ascontiguousarray(np.packbits(padded.T, axis=1, bitorder="little")).view(np.uint64)
    masks = np.where(bits.astype(bool), ONES, np.uint64(0))
    exists = np.zeros(words * 64, np.uint8)
    exists[:n] = 1
    absent = ~np.packbits(exists, bitorder="little").view(np.uint64)
    depth = (radius + 1).bit_length()
    found = []
    for start in range(0, n, TILE):
        rows = np.arange(start, min(n, start + TILE))
        q, w = (x.ravel() for x in np.meshgrid(rows, np.arange(start // 64, words), indexing="ij"))
        counters = [np.zeros(len(q), np.uint64) for _ in range(depth)]
        over = absent[w]
        for p in range(BITS):
            carry = planes[p, w] ^ masks[q, p]
            for c in counters:
                passed = c & carry
                c ^= carry
                carry = passed
            over |= carry
            if p % 8 == 7:
                over |= _beyond(counters, radius)
                alive = over != ONES
                if not alive.all():
                    q, w, over = q[alive], w[alive], over[alive]
                    counters = [c[alive] for c in counters]
                if not len(q):
                    break
        if len(q):
            block, lane = np.nonzero(np.unpackbits(np.ascontiguousarray(~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            i, j = q[block], w[block] * 64 + lane
            found.append(np.stack([i[i < j], j[i < j]]))
    both = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return both[0], both[1]


def _beyond(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is above ``radius``."""
    above, equal = np.zeros_like(counters[0]), np.full_like(counters[0], ONES)
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            equal = equal & counters[k]
        else:
            above |= equal & counters[k]
            equal = equal & ~counters[k]
    return above


def _stars(prints: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """One edge per linked fingerprint of a tile, to the least one it is joined with there."""
    left, right = close_pairs(prints, radius)
    if not len(left):
        return [], []
    label = np.arange(len(prints))
    while True:
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            break
    member = np.flatnonzero(label != np.arange(len(prints)))
    return prints[member].tolist(), prints[label[member]].tolist()


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket; whole buckets are packed into tiles and compared."""

    def out(members: np.ndarray) -> pa.RecordBatch:
        a, b = _stars(np.unique(members), radius)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    held, last, held_prints = None, None, []
    tile: list[np.ndarray] = []

    def close_bucket() -> Iterator[pa.RecordBatch]:
        nonlocal tile
        members = np.concatenate(held_prints)
        if len(members) > 1:
            tile.append(members)
            if sum(map(len, tile)) >= TILE:
                yield out(np.concatenate(tile))
                tile = []

    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in ("key", "i", "j")])
        prints = batch.column("fp").to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), len(prints)]
        for start, end in zip(edges, edges[1:]):
            if start == end:
                continue
            held = tuple(keys[:, start].tolist())
            if held != last and held_prints:
                yield from close_bucket()
                held_prints = []
            last = held
            held_prints.append(prints[start:end].astype(np.int64))
    if held_prints:
        yield from close_bucket()
    if tile:
        yield out(np.concatenate(tile))


def linked(prints: DataFrame, radius: int = 2) -> DataFrame:
    """(fp, root) for distinct fingerprints: root is the same for all that links connect.

    Fingerprints within the radius agree on two of radius + 2 bit blocks, so each is put
    into one bucket per pair of blocks.  Buckets with over ``CROWD`` members are cut into
    parts, and every pair of parts is compared as a unit of its own: no bucket is capped.
    """
    blocks = radius + 2
    cuts = [BITS * k // blocks for k in range(blocks + 1)]
    keys = []
    for number, (x, y) in enumerate(combinations(range(blocks), 2)):
        parts = [
            F.shiftrightunsigned("fp", cuts[k]).bitwiseAND(F.lit((1 << (cuts[k + 1] - cuts[k])) - 1)) for k in (x, y)
        ]
        keys.append(F.xxhash64(F.lit(number), *parts))
    rows = prints.select("fp").distinct().withColumn("key", F.explode(F.array(*keys)))
    crowded = rows.groupBy("key").count().where(F.col("count") > CROWD)
    crowded = cut_lineage(crowded.select("key", F.ceil(F.col("count") / CROWD).cast("int").alias("parts")))
    rows = lookup(rows, crowded, ["key"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp", "key"), F.col("parts")).cast("int")
    rows = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fp")
    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    edges = rows.mapInArrow(lambda it: _compare(it, radius), "a bigint, b bigint")
    return roots(edges).withColumnRenamed("a", "fp")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of every group: the smallest doc_id, null last, then a hash of the text.

    The winner of a group is picked on ids and hashes alone, as a minimum that combines
    before the shuffle, so a group of any size is cheap.  Rows are then matched to
    winners by id and text, and of rows that agree in both one is kept.
    """
    prints = cut_lineage(with_fingerprint(docs, doc_id, text, width, extra={"h": F.xxhash64(text)}))
    # The best row of every fingerprint combines before the shuffle, then that of every group.
    best = prints.groupBy("fp").agg(F.min(F.struct(F.isnull("doc_id").alias("last"), "doc_id", "h")).alias("best"))
    rooted = best.join(linked(prints, radius), "fp", "left").groupBy(F.coalesce("root", "fp")).agg(F.min("best").alias("best"))
    winners = cut_lineage(rooted.select(F.col("best.doc_id").alias("_winner"), F.col("best.h").alias("_of")))
    taken, back = carried(docs, docs.columns)
    rows = docs.select(*taken, F.col(f"`{doc_id}`").alias("id"), F.xxhash64(f"`{text}`").alias("h"))
    match = F.col("id").eqNullSafe(F.col("_winner")) & (F.col("h") == F.col("_of"))
    return rows.join(winners, match, "left_semi").dropDuplicates(["id", "h"]).select(*back)


def _named(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, root, component_id) for every fingerprint."""
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    rooted = classes.join(linked(prints, radius), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.select("fp", "root").join(names, "root")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp, root, component_id) per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of at most ``radius``
    differing bits; ``root`` names the component.  Rows are kept whatever they hold: null
    and empty texts have fingerprint 0 and link like any other, repeated rows come back
    repeated, null ids come back null and are passed over by the minimum.  Other columns
    are not read, so their names cannot clash.  An empty table gives an empty table.
    """
    prints = cut_lineage(with_fingerprint(docs, doc_id, text, width))
    return prints.join(_named(prints, radius), "fp").select("doc_id", "fp", "root", "component_id")

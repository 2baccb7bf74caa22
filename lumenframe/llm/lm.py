"""N-gram scores of texts by deleted interpolation, with exact counts over the whole corpus."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage
from .common import blank_words, byte_texts

# Roles of a document: counted, counted but set aside while weights are learned, scored only.
KEPT, DELETED, SCORED = 0, 1, 2
# Words of text packed into a block, the unit of counting; n-grams one reducing task gets.
BLOCK_BYTES = 8 << 20
PART_KEYS = 2_000_000
# Weights are learned on probabilities rounded to this fraction of a binary digit.
GRID = 4
BUCKETS = 48
NEVER, SHIFT = -1000, 200
_START, _END = np.uint64(0x9D1F3A5B7C2E4D61), np.uint64(0x5851F42D4C957F2D)


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = (left ^ (left >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD) + right * np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xC4CEB9FE1A85EC53)
    return out ^ (out >> np.uint64(32))


def _pack(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, like digits together."""
    octets = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(octets).tobytes())


def _unpack(data: bytes, kind: type, n: int) -> np.ndarray:
    octets = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=max(1, n * np.dtype(kind).itemsize)), np.uint8)
    return np.ascontiguousarray(octets.reshape(-1, n).T).view(kind).ravel() if n else np.zeros(0, kind)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Rising numbers by their differences."""
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def pack(docs: DataFrame, doc_id: str, text: str, role: Column) -> DataFrame:
    """Documents as blocks: one row per about ``BLOCK_BYTES`` of text of one role."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        held: dict[int, tuple[list, list]] = {}
        size = dict.fromkeys((KEPT, DELETED, SCORED), 0)

        def out(role: int, ids: pa.DataType) -> pa.RecordBatch:
            nonlocal made
            names, lines = held.pop(role)
            size[role] = 0
            data = b"\n".join(lines)
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId() * (1 << 24) + made], pa.int64()), pa.array([role], pa.int32()),
                 pa.array([names], pa.list_(ids)), pa.array([len(data) + len(lines)], pa.int64()),
                 pa.array([zstandard.ZstdCompressor(level=3).compress(data)], pa.binary())],
                names=["block_id", "role", "ids", "size", "data"],
            )

        ids = None
        for batch in batches:
            ids = batch.schema.field("doc_id").type
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("role").to_pylist(), byte_texts(batch.column("text")))
            for name, role, data in rows:
                line = b" ".join(blank_words(data))
                names, lines = held.setdefault(role, ([], []))
                names.append(name)
                lines.append(line)
                size[role] += len(line) + 1
                if size[role] >= BLOCK_BYTES:
                    yield out(role, ids)
        for role in sorted(held):
            yield out(role, ids)

    columns = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(role, F.lit(SCORED)).alias("role"))
    return columns.mapInArrow(run, f"block_id bigint, role int, ids array<{kind}>, size bigint, data binary")


@dataclass
class Block:
    """Tokens of a block: hashes of the n-gram ending at each, by order, and text ends."""

    ends: np.ndarray
    grams: list[np.ndarray] = field(default_factory=list)

    @staticmethod
    def read(data: bytes, size: int, order: int) -> Block:
        digest = xxhash.xxh64_intdigest
        hashes, counts = [], []
        for line in zstandard.ZstdDecompressor().decompress(data, max_output_size=size + 1).split(b"\n"):
            words = line.split()
            hashes.append(np.fromiter(map(digest, words), np.uint64, len(words)))
            hashes.append(np.array([_END]))
            counts.append(len(words) + 1)
        token = np.concatenate(hashes)
        ends = np.cumsum(counts)
        starts = np.zeros(len(token), bool)
        starts[0] = True
        starts[ends[:-1]] = True
        block = Block(ends, [token])
        for _ in range(1, order):
            # The (m - 1)-gram before, or the start mark, then this token.
            before = np.concatenate([[_START], block.grams[-1][:-1]])
            before[starts] = _START
            block.grams.append(_mix(before, token))
        return block


def _count(blocks: DataFrame, order: int, parts: int) -> DataFrame:
    """Counts of every distinct n-gram of a block, cut by hash range into ``parts`` rows."""
    shift = np.uint64(64 - (parts.bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.read(row["data"], row["size"], order)
                for m, grams in enumerate(block.grams, 1):
                    keys, counts = np.unique(grams, return_counts=True)
                    cut = np.searchsorted(keys >> shift, np.arange(parts + 1, dtype=np.uint64)) if parts > 1 else [0, len(keys)]
                    n = np.diff(cut)
                    spans = [slice(a, b) for a, b in zip(cut, cut[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["block_id"]] * parts, pa.int64()), pa.array([row["role"]] * parts, pa.int32()),
                         pa.array([m] * parts, pa.int32()), pa.array(range(parts), pa.int32()), pa.array(n, pa.int64()),
                         pa.array([_pack_keys(keys[s]) for s in spans], pa.binary()),
                         pa.array([_pack(counts[s].astype(np.uint32)) for s in spans], pa.binary())],
                        names=["block_id", "role", "m", "part", "n", "keys", "counts"],
                    )

    return blocks.select("block_id", "role", "size", "data").mapInArrow(
        run, "block_id bigint, role int, m int, part int, n bigint, keys binary, counts binary"
    )


_REPLY = "block_id bigint, role int, m int, part int, n bigint, learned binary, kept binary, tokens bigint, types bigint, kept_tokens bigint, kept_types bigint"


def _reply(group: pa.Table) -> pa.Table:
    """Corpus counts of one hash range, sent back to each block that asked, in its key order.

    ``learned`` has the training count; blocks that are set aside also get the count of
    the rest.  One more row has the totals of the range.
    """
    rows = sorted(group.to_pylist(), key=lambda r: r["block_id"])
    sizes = [r["n"] for r in rows]
    keys = np.concatenate([np.cumsum(_unpack(r["keys"], np.uint64, r["n"]), dtype=np.uint64) for r in rows])
    counts = np.concatenate([_unpack(r["counts"], np.uint32, r["n"]) for r in rows]).astype(np.int64)
    role = np.repeat([r["role"] for r in rows], sizes)
    order = np.argsort(keys, kind="stable")
    fresh = np.concatenate([[True], keys[order][1:] != keys[order][:-1]]) if len(keys) else np.zeros(0, bool)
    where = np.empty(len(keys), np.int64)
    where[order] = np.cumsum(fresh) - 1
    types = int(fresh.sum())
    learned = np.bincount(where, np.where(role == SCORED, 0, counts), types).astype(np.int64)
    kept = np.bincount(where, np.where(role == KEPT, counts, 0), types).astype(np.int64)
    ends = np.cumsum(sizes)
    out = []
    for r, b in zip(rows, ends):
        mine = where[b - r["n"] : b]
        out.append({
            "block_id": r["block_id"], "role": r["role"], "m": r["m"], "part": r["part"], "n": r["n"],
            "learned": _pack(learned[mine]), "kept": _pack(kept[mine]) if r["role"] == DELETED else None,
        })
    out.append({
        "block_id": None, "role": None, "m": rows[0]["m"], "part": rows[0]["part"], "n": 0,
        "tokens": int(learned.sum()), "types": int((learned > 0).sum()),
        "kept_tokens": int(kept.sum()), "kept_types": int((kept > 0).sum()),
    })
    return pa.Table.from_pylist(out, schema=_reply_schema())


def _reply_schema() -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _REPLY.split(", ")])


@dataclass
class Counts:
    """Corpus counts for the tokens of a block: of the n-gram at each, and of its context."""

    grams: list[np.ndarray]
    contexts: list[np.ndarray]

    @staticmethod
    def read(block: Block, replies: list[dict], column: str) -> Counts:
        grams, contexts = [], []
        starts = np.concatenate([[0], block.ends[:-1]])
        for m, gram in enumerate(block.grams, 1):
            keys, where = np.unique(gram, return_inverse=True)
            mine = sorted((r for r in replies if r["m"] == m), key=lambda r: r["part"])
            total = np.concatenate([_unpack(r[column], np.int64, r["n"]) for r in mine])
            if len(total) != len(keys):
                raise RuntimeError(f"{len(keys)} n-grams were asked for and {len(total)} answered")
            if m == 1:
                texts = total[np.searchsorted(keys, _END)]
            else:
                # What stands before a token; a text starts as often as one ends.
                before = np.concatenate([[0], grams[-1][:-1]])
                before[starts] = texts
                contexts.append(before)
            grams.append(total[where])
        return Counts(grams, contexts)


@dataclass
class Totals:
    tokens: int
    types: int


def estimates(counts: Counts, totals: Totals) -> list[np.ndarray]:
    """Maximum-likelihood estimates, from the uniform one over types and one unknown up."""
    n = len(counts.grams[0])
    out = [np.full(n, 1 / (totals.types + 1)), counts.grams[0] / max(totals.tokens, 1)]
    for gram, context in zip(counts.grams[1:], counts.contexts):
        out.append(np.divide(gram, context, out=np.zeros(n), where=context > 0))
    return out


def bucket(counts: Counts) -> np.ndarray:
    """Bucket of each token by how often its longest context was seen (doublings)."""
    if not counts.contexts:
        return np.zeros(len(counts.grams[0]), np.int64)
    return np.minimum(np.frexp(counts.contexts[-1].astype(np.float64))[1], BUCKETS - 1)


def _learn(events: list, orders: int) -> np.ndarray:
    """Mixture weights of each context bucket by expectation-maximisation.

    ``events``: bucket, rounded binary logarithm of each estimate over the uniform one
    (``NEVER``: zero), and how many tokens.  A bucket without events takes the weights of all.
    Steps go on until no weight moves by 1e-7.
    """
    weights = np.full((BUCKETS, orders), 1 / orders)
    if not events:
        return weights
    table = np.array([[e["bucket"], *e["cell"], e["n"]] for e in events], np.float64)

    def climb(rows: np.ndarray) -> np.ndarray:
        ratio = np.where(rows[:, 1:-1] == NEVER, 0, np.exp2(rows[:, 1:-1] / GRID))
        ratio = np.concatenate([np.ones((len(rows), 1)), ratio], axis=1)
        n, now = rows[:, -1:], np.full(orders, 1 / orders)
        while True:
            part = ratio * now
            after = (n * part / part.sum(axis=1, keepdims=True)).sum(axis=0) / n.sum()
            if np.abs(after - now).max() < 1e-7:
                # A little stays on the uniform estimate: any word has some probability.
                after = np.maximum(after, [1e-6] + [0] * (orders - 1))
                return after / after.sum()
            now = after

    weights[:] = climb(table)
    for b in np.unique(table[:, 0]).astype(int):
        weights[b] = climb(table[table[:, 0] == b])
    return weights


def _events(block: Block, replies: list[dict], totals: Totals) -> dict:
    counts = Counts.read(block, replies, "kept")
    uniform, *rest = estimates(counts, totals)
    cells = [np.where(p > 0, np.clip(np.round(GRID * np.log2(np.where(p > 0, p / uniform, 1))) + SHIFT, 0, 1022), -1).astype(np.int64) for p in rest]
    key = bucket(counts)
    for c in cells:
        key = key * 1024 + c + 1
    found, n = np.unique(key, return_counts=True)
    columns = []
    for _ in cells:
        columns.append(found % 1024 - 1)
        found = found // 1024
    cell = np.stack([np.where(c < 0, NEVER, c - SHIFT) for c in reversed(columns)], axis=1)
    return {"bucket": found, "cell": cell, "n": n}


def score(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    role: Column | None = None,
    order: int = 2,
) -> DataFrame:
    """Per row: doc_id, n_tokens, n_known, train_tokens, base_score and score (log10).

    Tokens are lower-cased words between ASCII blanks and one end per text.  ``role`` says
    for each row whether it is counted (``KEPT``), counted but set aside while the mixture
    weights are learned (``DELETED``), or only scored (``SCORED``, also for null).

    Texts are packed into blocks of bounded size.  Each block counts its own n-grams and
    sends every distinct one once, cut by hash range; a range sums the counts of all
    blocks and answers each in the order asked, so no n-gram is a hot key and nothing the
    size of the vocabulary is held in one place.  n-grams are told apart by 64-bit hashes.
    Weights per context-frequency bucket come from the documents set aside, against counts
    of the rest; scores use the counts of both.

    Null and empty texts are a single end.  Repeated rows count and come back repeated.
    Without counted text every word has the uniform probability 1 / (types + 1) = 1.
    """
    role = F.lit(KEPT) if role is None else role
    blocks = cut_lineage(pack(docs, doc_id, text, role))
    size = blocks.agg(F.sum("size")).first()[0] or 0
    parts = 1 << max(3, (order * size // 8 // PART_KEYS).bit_length())
    replies = cut_lineage(_count(blocks, order, parts).groupBy("m", "part").applyInArrow(_reply, _REPLY))
    sums = replies.where("block_id is null and m = 1").agg(*[F.sum(c) for c in ("tokens", "types", "kept_tokens", "kept_types")]).first()
    all_counts, kept_counts = Totals(sums[0] or 0, sums[1] or 0), Totals(sums[2] or 0, sums[3] or 0)
    asked = replies.where("block_id is not null").select("block_id", "role", "m", "part", "n", "learned", "kept")

    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        found = _events(Block.read(row["data"], row["size"], order), right.to_pylist(), kept_counts)
        return pa.table({"bucket": pa.array(found["bucket"], pa.int32()), "cell": pa.array(found["cell"].tolist(), pa.list_(pa.int32())), "n": pa.array(found["n"], pa.int64())})

    aside = blocks.where(F.col("role") == DELETED).groupBy("block_id")
    events = aside.cogroup(asked.where(F.col("role") == DELETED).select("block_id", "m", "part", "n", "kept").groupBy("block_id"))
    events = events.applyInArrow(gather, "bucket int, cell array<int>, n bigint")
    weights = _learn(events.groupBy("bucket", "cell").agg(F.sum("n").alias("n")).collect(), order + 1)

    def rate(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        block = Block.read(row["data"], row["size"], order)
        counts = Counts.read(block, right.to_pylist(), "learned")
        parts = estimates(counts, all_counts)
        share = weights[bucket(counts)]
        if not all_counts.tokens:
            share[:, 1] = 0
        if counts.contexts:
            # Estimates after a context never seen say nothing: their weight goes to the others.
            for m, context in enumerate(counts.contexts, 2):
                share[context == 0, m] = 0
        share /= share.sum(axis=1, keepdims=True)
        chance = np.log10(sum(share[:, k] * p for k, p in enumerate(parts)))
        c = counts.grams[0]
        base = np.log10((c + 0.1) / (all_counts.tokens + 0.1 * (all_counts.types + 1)))
        starts = np.concatenate([[0], block.ends[:-1]])
        n = len(starts)
        return pa.table({
            "doc_id": pa.array(row["ids"], left.schema.field("ids").type.value_type),
            "n_tokens": pa.array(np.diff(np.concatenate([[0], block.ends])), pa.int64()),
            "n_known": pa.array(np.add.reduceat((c > 0).astype(np.int64), starts), pa.int64()),
            "train_tokens": pa.array([all_counts.tokens] * n, pa.int64()),
            "base_score": pa.array(np.add.reduceat(base, starts), pa.float64()),
            "score": pa.array(np.add.reduceat(chance, starts), pa.float64()),
        })

    kind = docs.schema[doc_id].dataType.simpleString()
    both = blocks.groupBy("block_id").cogroup(asked.select("block_id", "m", "part", "n", "learned").groupBy("block_id"))
    return both.applyInArrow(
        rate, f"doc_id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )

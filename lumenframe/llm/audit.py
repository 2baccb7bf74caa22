"""How text filters interact: measures by a byte transducer, and what each order of the filters removes."""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage, lookup
from .common import byte_texts, carried, ddl, pieces

# Bytes of a strip: few enough that every count in it fits in a field of 16 bits.
STRIP = 1 << 15
# Bytes of short texts measured together; a longer text is measured alone.
TOGETHER = 1 << 20
# Spans longer than this are compared whole, shorter ones eight bytes at a time.
LONG_SPAN = 64
MEASURES = ["n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"]
# The symbols that are counted.
SYMBOLS = b"#$%&*|"

_BLANK = np.isin(np.arange(256), list(b"\x20\x09\x0a\x0b\x0c\x0d"))
_FIELD = {"n_words": 0, "n_capitals": 16, "n_points": 32, "n_symbols": 48}


def _table() -> np.ndarray:
    """What the transducer adds at each (state, byte): a word, a capital, a code point, a symbol.

    State 1 is inside a word.  The next state depends on the byte alone: blanks lead to 0,
    all others to 1.  Continuation bytes of UTF-8 begin no code point.
    """
    byte = np.arange(256)
    add = np.zeros((2, 256), np.uint64)
    add[0, ~_BLANK] += np.uint64(1 << _FIELD["n_words"])
    add[:, (byte >= 65) & (byte <= 90)] += np.uint64(1 << _FIELD["n_capitals"])
    add[:, (byte < 128) | (byte >= 192)] += np.uint64(1 << _FIELD["n_points"])
    add[:, list(SYMBOLS)] += np.uint64(1 << _FIELD["n_symbols"])
    return add.ravel()


_ADD = _table()
_STATE = (~_BLANK).astype(np.uint8)
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
# Powers of the base and of its inverse modulo 2^64, to the end of a strip.
_POWER = np.cumprod(np.array([1] + [_BASE] * STRIP, np.uint64), dtype=np.uint64)
_BACK = np.cumprod(np.array([1] + [pow(_BASE, -1, 1 << 64)] * STRIP, np.uint64), dtype=np.uint64)
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


class Spans:
    """Hash table of spans of a buffer, open addressing; equal hashes are verified byte by byte.

    A span is known by its text and the document it stands in, so one table serves many
    texts.  It holds each distinct span once and doubles before it is half full.
    """

    def __init__(self, data: np.ndarray):
        """``data`` is followed by at least eight bytes of padding."""
        self.data = data
        self.eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        self.filled = 0
        self._allocate(1 << 12)

    def _allocate(self, size: int) -> None:
        self.bits = np.uint64(size - 1)
        self.key = np.zeros(size, np.uint64)
        self.start = np.full(size, -1, np.int64)
        self.length = np.zeros(size, np.int64)
        self.doc = np.zeros(size, np.int64)

    def _equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        same = np.ones(len(a), bool)
        left = np.flatnonzero((a != b) & (length <= LONG_SPAN))
        at = 0
        while len(left):
            apart = self.eights[a[left] + at] ^ self.eights[b[left] + at]
            same[left] = (apart & _MASK[np.minimum(length[left] - at, 8)]) == 0
            at += 8
            left = left[same[left] & (length[left] > at)]
        for i in np.flatnonzero((a != b) & (length > LONG_SPAN)).tolist():
            n = length[i]
            same[i] = self.data[a[i] : a[i] + n].tobytes() == self.data[b[i] : b[i] + n].tobytes()
        return same

    def insert(self, key: np.ndarray, start: np.ndarray, length: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Insert spans; the documents of those that were new, once for each."""
        while 2 * (self.filled + len(key)) > len(self.start):
            held = np.flatnonzero(self.start >= 0)
            old = self.key[held], self.start[held], self.length[held], self.doc[held]
            self._allocate(2 * len(self.start))
            self._place(*old)
        new = self._place(key, start, length, doc)
        self.filled += len(new)
        return new

    def _place(self, key: np.ndarray, start: np.ndarray, length: np.ndarray, doc: np.ndarray) -> np.ndarray:
        new, left, probe = [], np.arange(len(key)), 0
        while len(left):
            slot = ((key[left] + np.uint64(probe * (probe + 1) // 2)) & self.bits).astype(np.int64)
            free = self.start[slot] < 0
            # Of several that want one free slot the last written holds it.
            mine, where = left[free], slot[free]
            self.start[where] = start[mine]
            held = self.start[where] == start[mine]
            mine, where = mine[held], where[held]
            self.key[where], self.length[where], self.doc[where] = key[mine], length[mine], doc[mine]
            new.append(doc[mine])
            same = (self.key[slot] == key[left]) & (self.doc[slot] == doc[left]) & (self.length[slot] == length[left])
            found = np.flatnonzero(same)
            same[found] = self._equal(start[left[found]], self.start[slot[found]], length[left[found]])
            left, probe = left[~same], probe + 1
        return np.concatenate(new) if new else np.zeros(0, np.int64)


def measure_texts(texts: list[bytes | None]) -> dict[str, np.ndarray]:
    """Words, distinct words, capitals, code points and symbols of each text, in one pass.

    The texts stand in one buffer with a blank after each, which closes its last word, and
    pass through the transducer strip by strip; the state, and the start and hash of a
    word that is open, go over to the next strip.
    """
    texts = [t or b"" for t in texts]
    data = np.frombuffer(b" ".join([*texts, b" " * 8]), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    total = {m: np.zeros(len(texts), np.int64) for m in MEASURES}
    spans = Spans(data)
    inside, open_at, open_hash = 0, 0, np.zeros(1, np.uint64)
    for at in range(0, int(sizes.sum()), STRIP):
        strip = data[at : min(at + STRIP, int(sizes.sum()))]
        after = _STATE[strip]
        before = np.concatenate([np.array([inside], np.uint8), after[:-1]])
        adds = _ADD[before.astype(np.intp) * 256 + strip]
        first, last = np.searchsorted(begins, [at, at + len(strip) - 1], side="right") - 1
        cuts = np.maximum(begins[first : last + 1] - at, 0)
        sums = np.add.reduceat(adds, cuts)
        for name, shift in _FIELD.items():
            total[name][first : last + 1] += ((sums >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.int64)

        hashes = np.concatenate([np.zeros(1, np.uint64), np.cumsum((strip + np.uint64(1)) * _POWER[: len(strip)], dtype=np.uint64)])
        starts, ends = np.flatnonzero(before < after), np.flatnonzero(before > after)
        if inside:
            # The open word goes on from the first byte of the strip.
            end = int(ends[0]) if len(ends) else len(strip)
            so_far = at - open_at
            power = np.array([pow(_BASE, so_far, 1 << 64)], np.uint64)
            open_hash = open_hash + power * hashes[end : end + 1]
        closed = starts[: len(ends) - inside] if len(ends) else starts[:0]
        whole = ends[inside:]
        found = [(at + closed, whole - closed, (hashes[whole] - hashes[closed]) * _BACK[closed])]
        if inside and len(ends):
            found.append((np.array([open_at]), np.array([at + int(ends[0]) - open_at]), open_hash))
        if after[-1] and (len(starts) > len(closed)):
            # The last word of the strip stays open.
            begin = starts[-1:]
            open_at, open_hash = at + int(begin[0]), (hashes[-1:] - hashes[begin]) * _BACK[begin]
        inside = int(after[-1])
        start, length, code = (np.concatenate(x) for x in zip(*found))
        doc = np.searchsorted(begins, start, side="right") - 1
        code = (code ^ (doc.astype(np.uint64) * _MIX)) * np.uint64(_BASE)
        code ^= code >> np.uint64(32)
        total["n_distinct"] += np.bincount(spans.insert(code, start, length, doc), minlength=len(texts))
    total["n_points"] -= 1  # the blank after the text
    return total


def measure(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` and, of every whole text, its words (runs of non-blank bytes), distinct
    words, capitals A-Z, code points and symbols.

    A null text counts as an empty one; bytes that are no UTF-8 count as code points where
    they are no continuation bytes.  A text of any length passes in strips: beside the text
    itself a task holds its distinct words only.  Repeated rows are measured each.
    """
    inner, outer = carried(docs, keep)
    chosen = docs.select(*inner, F.col(f"`{text}`").alias("_in"))
    names = [f"_c{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "_in", TOGETHER):
            found = measure_texts(byte_texts(piece.column("_in")))
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in names), *(pa.array(found[m]) for m in MEASURES)], names=[*names, *(f"_{m}" for m in MEASURES)]
            )

    schema = ", ".join(filter(None, [ddl(chosen.drop("_in")), *(f"_{m} bigint" for m in MEASURES)]))
    return chosen.mapInArrow(run, schema).select(*outer, *[F.col(f"_{m}").alias(m) for m in MEASURES])


def failures() -> dict[str, Column]:
    """Filters over the measures and ``first_id``: the condition under which each removes a text."""
    return {
        "A": F.col("n_words") < 200,
        "B": 100 * F.col("n_distinct") < 50 * F.col("n_words"),
        "C": 100 * F.col("n_capitals") > 2 * F.col("n_points"),
        "D": F.col("n_symbols") > 0,
        "E": F.col("doc_id") > F.col("first_id"),
    }


def failed(docs: DataFrame, filters: dict[str, Column] | None = None, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(doc_id, part, mask, n): n equal rows whose texts fail the filters whose bits ``mask`` has.

    Bit i belongs to the i-th filter.  ``first_id`` in a filter is the smallest doc_id of an
    identical text, or null where no other has it; null texts are identical to empty ones.
    A null doc_id is smaller than none and larger than none.  A null part is ''.
    """
    filters = failures() if filters is None else filters
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    found = measure(rows, ["doc_id", "part", "digest"])
    # Repeated rows are one from here on, so none of them makes a hot key.
    facts = cut_lineage(found.groupBy(*found.columns).agg(F.count(F.lit(1)).alias("n")))
    same = facts.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("_last")).where("first_id < _last").drop("_last")
    joined = lookup(facts, same, ["digest"], "left")
    bits = [F.when(fails, F.lit(1 << i)).otherwise(0) for i, fails in enumerate(filters.values())]
    return joined.select("doc_id", "part", sum(bits, F.lit(0)).alias("mask"), "n")


def orders(names: list[str]) -> Column:
    """Every order of the filters, step by step: the filter's bit, and those of all before it."""
    bit = {name: 1 << i for i, name in enumerate(names)}
    rows = [
        {"filter_order": "".join(order), "step": i + 1, "bit": bit[name], "before": sum(bit[x] for x in order[:i])}
        for order in permutations(names)
        for i, name in enumerate(order)
    ]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order: string, step: int, bit: int, before: int>>")


def audit(
    docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None,
    doc_id: str = "doc_id", text: str = "text", part: str = "source",
) -> DataFrame:
    """What every order of the filters removes at every step, by part of the table.

    One row per part, order and step: the rows kept after it, removed by it, redundant
    (failing its filter but removed before), failing its filter only, good and toxic ones
    removed here, and the filter's removals added up over all orders.  These follow from
    the numbers of rows that fail each combination of filters, at most 2^k a part, so the
    documents are read once whatever the number of orders.

    ``labels`` has doc_id, quality and toxic; a document is good, or toxic, if any of its
    labels says so; a null doc_id has no label.  A repeated row counts as often as it
    stands.  An empty table has no parts and gives an empty result.  At most six filters of
    one letter each.
    """
    filters = failures() if filters is None else filters
    if not 0 < len(filters) <= 6 or any(len(f) != 1 for f in filters):
        raise ValueError("one to six filters, each named by one letter")
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    rows = lookup(failed(docs, filters, doc_id, text, part), marks, ["doc_id"], "left")
    sums = [F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")]
    counts = rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), *sums)
    # At most 2^k entries for a part.
    per_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    steps = per_part.withColumn("o", F.explode(orders(list(filters)))).select("part", "counts", "o.*")

    def added(value: str, when) -> Column:
        entries = F.transform(F.filter("counts", when), lambda e: e[value])
        return F.aggregate(entries, F.lit(0).cast("bigint"), lambda s, x: s + x)

    bit, before = F.col("bit"), F.col("before")
    fails = lambda e: e["mask"].bitwiseAND(bit) != 0
    gone = lambda e: e["mask"].bitwiseAND(before) != 0
    here = lambda e: fails(e) & ~gone(e)
    # Of all orders, each filter that a row fails comes first among them equally often.
    share = F.transform(
        F.filter("counts", fails), lambda e: F.call_function("div", e["n"] * factorial(len(filters)), F.bit_count(e["mask"]))
    )
    return steps.select(
        "part", "filter_order", "step",
        added("n", lambda e: e["mask"].bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        added("n", here).alias("removed"),
        added("n", lambda e: fails(e) & gone(e)).alias("redundant"),
        added("n", lambda e: e["mask"] == bit).alias("unique_fails"),
        added("good", here).alias("good_lost"),
        added("toxic", here).alias("toxic_lost"),
        F.aggregate(share, F.lit(0).cast("bigint"), lambda s, x: s + x).alias("shapley"),
    )

"""Benchmark passages in documents, found by winnowed fingerprints and extended hits."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage
from .common import byte_texts, carried, ddl

# Words are runs of ASCII letters and digits and of bytes beyond ASCII, A-Z lower-cased.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.uint64(0xD6E8FEB86659FD93)
# Words of benchmark text handled in one pass over the documents.
BLOCK_WORDS = 500_000


def words_of(data: bytes | None) -> list[bytes]:
    return data.translate(_WORDS).split() if data else []


def gram_hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every run of ``k`` word numbers."""
    n = len(ids) - k + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * _SALT
    mixed ^= mixed >> np.uint64(29)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _BASE + mixed[j : j + n]
    out ^= out >> np.uint64(32)
    out *= _SALT
    return out ^ (out >> np.uint64(29))


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions kept: the last smallest hash of each run of ``window`` hashes.

    Two texts that share a run of window + k - 1 words have a whole window of hashes in
    common, so both keep the same place in it.
    """
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64)
    window = min(window, n)
    best = hashes[: n - window + 1].copy()
    where = np.arange(n - window + 1)
    for j in range(1, window):
        other = hashes[j : n - window + 1 + j]
        lower = other <= best
        best[lower] = other[lower]
        where[lower] = np.flatnonzero(lower) + j
    return np.unique(where)


class Index:
    """Fingerprints of a block of benchmark items, small enough to send to every task.

    ``span`` is the number of words in a window.  ``k`` is chosen so that k-grams under a
    winnowing window of span - k + 1 cover exactly a span.  Items shorter than ``span``
    are one window of their own length and have one hash each.
    """

    def __init__(self, items: list[tuple[object, bytes | None]], span: int, k: int) -> None:
        self.span, self.k = span, k
        self.vocabulary: dict[bytes, int] = {}
        self.ids: list[object] = []
        self.texts: list[np.ndarray] = []
        for item, text in items:
            words = words_of(text)
            if words:
                number = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
                self.ids.append(item)
                self.texts.append(np.array(number, np.int64))
        entries: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for t, numbers in enumerate(self.texts):
            if len(numbers) < span:
                entries[len(numbers)].append((int(gram_hashes(numbers, len(numbers))[0]), t, 0))
            else:
                hashes = gram_hashes(numbers, k)
                entries[0] += [(int(hashes[p]), t, int(p)) for p in winnow(hashes, span - k + 1)]
        # 0 stands for the winnowed k-grams, m > 0 for whole items of m words.
        self.tables = {}
        for m, rows in entries.items():
            rows.sort()
            self.tables[m] = (np.array([r[0] for r in rows], np.uint64), [r[1:] for r in rows])

    def hits(self, data: bytes | None) -> tuple[int, list[tuple[int, int]], set[int]]:
        """Number of words, disjoint hit ranges in order, and items with a window in the text."""
        words = words_of(data)
        known = self.vocabulary.get
        ids = np.fromiter((known(w, -1) for w in words), np.int64, len(words))
        ranges: list[tuple[int, int]] = []
        found: set[int] = set()
        for m, (hashes, places) in self.tables.items():
            grams = gram_hashes(ids, m or self.k)
            at = winnow(grams, self.span - self.k + 1) if m == 0 else np.arange(len(grams))
            probe = grams[at]
            low = np.searchsorted(hashes, probe, "left")
            done: dict[tuple[int, int], int] = {}
            for p in np.flatnonzero(np.searchsorted(hashes, probe, "right") > low):
                i, entry = int(at[p]), int(low[p])
                while entry < len(hashes) and hashes[entry] == probe[p]:
                    t, j = places[entry]
                    entry += 1
                    if done.get((t, i - j), -1) >= i:
                        continue
                    start, end = self._extend(ids, i, self.texts[t], j)
                    done[t, i - j] = end
                    if end - start >= (m or self.span):
                        ranges.append((start, end))
                        found.add(t)
        return len(words), merged(ranges), found

    @staticmethod
    def _extend(doc: np.ndarray, i: int, item: np.ndarray, j: int) -> tuple[int, int]:
        """Longest common run around word ``i`` of the document and ``j`` of the item."""
        back = min(i, j)
        differ = np.flatnonzero(doc[i - back : i] != item[j - back : j])
        start = i - back + (int(differ[-1]) + 1 if len(differ) else 0)
        ahead = min(len(doc) - i, len(item) - j)
        differ = np.flatnonzero(doc[i : i + ahead] != item[j : j + ahead])
        return start, i + (int(differ[0]) if len(differ) else ahead)


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _blocks(benchmark: DataFrame, item_id: str, text: str, limit: int) -> Iterator[list[tuple[object, bytes | None]]]:
    """Distinct items in blocks of about ``limit`` words; one block is on the driver at a time."""
    rows = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).distinct()
    block, size = [], 0
    for row in rows.toLocalIterator():
        data = None if row["text"] is None else row["text"].encode()
        length = len(words_of(data))
        if block and size + length > limit:
            yield block
            block, size = [], 0
        block.append((row["item_id"], data))
        size += length
    yield block


def _pass(docs: DataFrame, keep: list[str], index: Index) -> DataFrame:
    """The wanted columns, word count, hit ranges and item ids, for one benchmark block."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    item_names = [None if i is None else str(i) for i in index.ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            counts, spans, items = [], [], []
            for data in byte_texts(batch.column("_whole")):
                n, ranges, found = known.hits(data)
                counts.append(n)
                spans.append([{"start": a, "end": b} for a, b in ranges])
                items.append(sorted({item_names[t] for t in found if item_names[t] is not None}))
            pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pair)), pa.array(items, pa.list_(pa.string()))],
                names=[*keep, "n_words", "spans", "items"],
            )

    schema = [ddl(docs.select(*keep)), "n_words bigint", "spans array<struct<start: bigint, end: bigint>>", "items array<string>"]
    return docs.select(*keep, "_whole").mapInArrow(run, ", ".join(schema))


def _found(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text: str,
    item_id: str = "item_id",
    item_text: str = "text",
    span: int = 10,
    k: int = 6,
    block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, list[Column]]:
    """What ``contamination`` finds, beside ``keep`` under neutral names, and those columns named again."""
    taken, back = carried(docs, keep)
    docs = docs.select(*taken, F.col(f"`{text}`").alias("_whole"))
    keep = docs.columns[:-1]
    blocks = _blocks(benchmark, item_id, item_text, block_words)
    first = Index(next(blocks), span, k)
    second = next(blocks, None)
    if second is None:
        return _pass(docs, keep, first), back
    # Written once, so that the row numbers are the same in every pass.
    rows = cut_lineage(docs.withColumn("_row", F.monotonically_increasing_id()))
    first_pass = _pass(rows, ["_row", *keep], first)
    others = None
    while second is not None:
        one = _pass(rows, ["_row"], Index(second, span, k)).drop("n_words")
        others = one if others is None else others.union(one)
        second = next(blocks, None)
    united = first_pass.select("_row", "spans", "items").union(others).groupBy("_row").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    zero = F.array().cast("array<struct<start: bigint, end: bigint>>")

    def step(acc, x):
        last = F.get(acc, F.size(acc) - 1)
        grown = F.concat(
            F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))),
        )
        return F.when((F.size(acc) > 0) & (x["start"] <= last["end"]), grown).otherwise(F.concat(acc, F.array(x)))

    joined = F.aggregate(F.array_sort("spans"), zero, step).alias("spans")
    return first_pass.select("_row", *keep, "n_words").join(united.select("_row", joined, "items"), "_row"), back


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; see ``contamination``.

    The columns may have any names.
    """
    found, back = _found(docs, benchmark, docs.columns, text, **options)
    return found.where(F.size("spans") == 0).select(*back)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: tuple[str, ...] | list[str] = ("doc_id",),
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    span: int = 10,
    k: int = 6,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per document: ``keep``, n_words, spans (hit word ranges) and items (ids as sorted strings).

    A window is ``span`` consecutive words of an item, or a whole shorter item that has
    words.  Every document word inside an occurrence of a window is in a span, whatever
    else surrounds it: winnowing cannot miss a shared run of ``span`` words, and each hit
    is extended on the words themselves, so nothing is reported by hash alone.

    The documents are only mapped over, so a passage that most of them hold makes no hot
    key.  A benchmark of more than ``block_words`` words is taken in blocks, each sent to
    the tasks in a pass of its own; ranges of one document are united afterwards.

    Null and empty texts have no words and no hits; repeated documents come back repeated;
    items with a null id mark hits but are not listed; an empty benchmark marks nothing.
    Kept columns may have any names but those of the result.
    """
    found, back = _found(docs, benchmark, list(keep), text, item_id, item_text, span, k, block_words)
    return found.select(*back, "n_words", "spans", "items")


def hit_words(spans: str = "spans"):
    """Number of words in the ranges."""
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda acc, s: acc + s["end"] - s["start"])

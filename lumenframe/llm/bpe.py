"""Byte-level BPE: merges by a priority queue over a linked list of symbols; decoding by concatenation.

A vocabulary is a file of the public ``tokenizers`` JSON format; its path is a parameter,
it is read on the driver and broadcast (its size is that of the file, whatever the
corpus).  Rows are only mapped over, nothing is shuffled.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, carried, ddl, pieces

# Fixed value: the public pattern that cuts text into words before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters handled at once; a block ends where blanks begin, which no word crosses.
BLOCK = 1 << 20
# Words remembered by a worker: so many, none longer than so many characters.
MEMORY, LONGEST = 400_000, 48


def byte_names() -> dict[str, int]:
    """Character that stands for each byte in such vocabularies: itself where it prints,
    otherwise the next one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    names = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    return names | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Vocabulary:
    """``pieces``: bytes of each id.  ``ranks``: (left id << 32 | right id) to the rank of
    their merge.  ``made``: id that the merge of each rank gives.  ``whole``: strings that
    are one token wherever they stand, with their ids."""

    pieces: dict[int, bytes]
    ranks: dict[int, int]
    made: list[int]
    whole: dict[str, int]
    single: list[int] = field(init=False)

    def __post_init__(self) -> None:
        by_piece = {p: i for i, p in self.pieces.items() if len(p) == 1}
        self.single = [by_piece[bytes([b])] for b in range(256)]
        self.known: dict[str, bytes] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}

    def merged(self, word: bytes) -> list[int]:
        """Ids of a word.

        Symbols are a doubly linked list; a heap holds (rank, place) of neighbours that
        merge.  ``due`` is the rank that holds now at a place: a heap entry of another
        rank is stale and skipped.  The least rank goes first, then the leftmost place.
        """
        ids = [self.single[b] for b in word]
        n, ranks = len(ids), self.ranks
        due = [ranks.get(a << 32 | b, -1) for a, b in zip(ids, ids[1:])]
        heap = [r << 32 | i for i, r in enumerate(due) if r >= 0]
        if not heap:
            return ids
        due.append(-1)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heapify(heap)
        while heap:
            entry = heappop(heap)
            at, rank = entry & 0xFFFFFFFF, entry >> 32
            if due[at] != rank:
                continue
            gone = after[at]
            ids[at] = symbol = self.made[rank]
            ids[gone] = due[gone] = -1
            after[at] = right = after[gone]
            due[at] = -1
            if right < n:
                before[right] = at
                rank = ranks.get(symbol << 32 | ids[right], -1)
                if rank >= 0:
                    due[at] = rank
                    heappush(heap, rank << 32 | at)
            left = before[at]
            if left >= 0:
                due[left] = rank = ranks.get(ids[left] << 32 | symbol, -1)
                if rank >= 0:
                    heappush(heap, rank << 32 | left)
        return [i for i in ids if i >= 0]

    def word(self, word: str) -> bytes:
        """Packed ids of a word, remembered if it is short."""
        found = self.known.get(word)
        if found is None:
            found = pack(self.merged(word.encode("utf-8", "replace")))
            if len(word) <= LONGEST:
                if len(self.known) >= MEMORY:
                    self.known.clear()
                self.known[word] = found
        return found

    def encode(self, text: str) -> bytes:
        """Packed ids of a whole text."""
        out = []
        sections = regex.split("(" + "|".join(map(regex.escape, sorted(self.whole, key=len, reverse=True))) + ")", text) if self.whole else [text]
        for i, section in enumerate(sections):
            if i % 2:
                out.append(pack([self.whole[section]]))
                continue
            for block in blocks(section):
                words = _words(block)
                try:
                    out.append(b"".join([self.known[w] for w in words]))
                except KeyError:
                    out.append(b"".join([self.word(w) for w in words]))
        return b"".join(out)

    def decode(self, packed: bytes) -> bytes:
        """UTF-8 of the ids' strings; ids outside the vocabulary give nothing, and bytes
        that are no UTF-8 give U+FFFD."""
        out, piece = [], self.pieces
        for at in range(0, len(packed), 4 * BLOCK):
            out.append(b"".join([piece.get(i, b"") for i in unpack(packed[at : at + 4 * BLOCK])]))
        whole = b"".join(out)
        try:
            whole.decode()
            return whole
        except UnicodeDecodeError:
            return whole.decode("utf-8", "replace").encode()


_words = regex.compile(WORDS).findall
# As many characters as allowed, then to the end of a word; or what blanks are left.
_block = regex.compile(rf"(?s).{{0,{BLOCK}}}\s*\S+|\s+")


def blocks(text: str) -> Iterator[str]:
    """Parts of a text that end before blanks: cutting there changes no word."""
    if len(text) <= BLOCK:
        yield text
    else:
        yield from (m.group() for m in _block.finditer(text))


def pack(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    numbers = array("I", ids)
    if numbers.itemsize != 4:
        return b"".join(i.to_bytes(4, "little") for i in ids)
    if _SWAP:
        numbers.byteswap()
    return numbers.tobytes()


def unpack(packed: bytes) -> array:
    numbers = array("I")
    numbers.frombytes(packed)
    if _SWAP:
        numbers.byteswap()
    return numbers


_SWAP = array("I", [1]).tobytes()[:1] != b"\1"


def load(path: str) -> Vocabulary:
    """The vocabulary of a JSON file; forms other than byte-level BPE with the pattern above raise."""
    with open(path, encoding="utf-8") as lines:
        form = json.load(lines)
    model, cut = form["model"], form["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not form["normalizer"] and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
    odd = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
    flags = ("single_word", "lstrip", "rstrip")
    if not plain or cut.get("add_prefix_space") or any(model.get(k) for k in odd) or any(a[f] for a in form["added_tokens"] for f in flags):
        raise ValueError("not a plain byte-level BPE vocabulary")
    names = byte_names()

    def raw(token: str) -> bytes:
        return bytes([names[c] for c in token])

    ids = {raw(t): i for t, i in model["vocab"].items()}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    parts = [(raw(a), raw(b)) for a, b in pairs]
    whole = {a["content"]: a["id"] for a in form["added_tokens"]}
    return Vocabulary(
        {i: p for p, i in ids.items()} | {i: t.encode() for t, i in whole.items()},
        {ids[a] << 32 | ids[b]: r for r, (a, b) in enumerate(parts)},
        [ids[a + b] for a, b in parts],
        whole,
    )


def _mapped(rows: DataFrame, keep: list[str], source: str, out: str, kind: str, work) -> DataFrame:
    """Carry ``keep`` and add ``out``: ``work`` of the column ``source`` in each row."""
    inner, outer = carried(rows, keep)
    chosen = rows.select(*inner, F.col(f"`{source}`").alias("_in"))
    names = [f"_c{i}" for i in range(len(keep))]
    arrow = pa.binary() if kind == "binary" else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "_in"):
            made = pa.array([work(x) for x in byte_texts(piece.column("_in"))], pa.binary()).cast(arrow)
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in names), made], names=[*names, "_out"])

    schema = ", ".join(filter(None, [ddl(chosen.drop("_in")), f"_out {kind}"]))
    return chosen.mapInArrow(run, schema).select(*outer, F.col("_out").alias(out))


def encode(docs: DataFrame, vocabulary: Vocabulary, keep: list[str], text: str = "text", out: str = "ids") -> DataFrame:
    """Columns ``keep`` and the ids of every whole text, packed as little-endian 32-bit integers.

    A null or empty text has no ids (empty, not null).  Strings in ``vocabulary.whole``
    are one token wherever they stand.  A very long text is cut where blanks begin, which
    changes no id; a very long word costs n log n.  Repeated rows are encoded each; an
    empty table gives an empty one; other columns and their names play no part.  The
    packed ids of one text must fit in 2 GB.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return _mapped(docs, keep, text, out, "binary", lambda t: shared.value.encode(t.decode("utf-8", "replace")) if t else b"")


def decode(rows: DataFrame, vocabulary: Vocabulary, keep: list[str], ids: str = "ids", out: str = "text") -> DataFrame:
    """Columns ``keep`` and the text of packed ids: their strings, one after the other.

    Null or no ids give an empty text, ids outside the vocabulary nothing, and bytes that
    are no UTF-8 the replacement character.
    """
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    return _mapped(rows, keep, ids, out, "string", lambda p: shared.value.decode(p) if p else b"")


def count(ids: str = "ids") -> Column:
    """Number of packed ids."""
    return (F.octet_length(ids) / 4).cast("long")

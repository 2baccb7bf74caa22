"""Language of texts: script ranges, character models, and Viterbi over the words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import PIECE_BYTES, byte_texts, carried, ddl, pieces

# Hashed character trigrams and their contexts: with the languages they bound the model.
CELLS = 1 << 15
MAX_LANGUAGES = 256
# Cost, in natural logarithm units, of a change of language from one word to the next.
SWITCH = 6.0
# Pseudo-counts of a trigram after its context, spread over this many letters.
SMOOTH, LETTERS = 4.0, 64
# A single word counts at most this much for one language against another.
WORD_LIMIT = 12.0
UNDECIDED = "und"
# Least share of its letters that makes a script one of a language.
MIN_SHARE = 0.005

# Unicode script ranges, first and last code point.  Letters outside all of
# them form one further script.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF),
              (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "ethiopic": [(0x1200, 0x139F)],
    "khmer": [(0x1780, 0x17FF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
}
OTHER = len(SCRIPTS) + 1


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Script of every code point (0: no letter) and its single lower-case code point."""
    letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    script = np.zeros(0x110000, np.uint8)
    script[letters] = OTHER
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            script[first : last + 1] = np.where(letters[first : last + 1], number, 0)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in np.flatnonzero(letters).tolist():
        low = chr(c).lower()
        if len(low) == 1:
            lower[c] = ord(low)
    return script, lower


@dataclass
class Words:
    """Words of a run of texts: letters of one script in a row.

    ``text``: number of the text; ``start``, ``end``: code points within it; ``cell`` and
    ``context``: hashed trigram ending at each letter or at the end of the word, and its
    first two signs; ``first``: where the trigrams of each word begin.
    """

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    cell: np.ndarray
    context: np.ndarray
    first: np.ndarray


def _hash(*parts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        out = (out ^ p.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return (out % np.uint64(CELLS)).astype(np.int32)


def words_of(texts: list[bytes | None]) -> Words:
    script_of, lower_of = _tables()
    # A blank after each text keeps words apart.
    coded = [(t or b"").decode().encode("utf-32-le") for t in texts]
    points = np.frombuffer(b" \0\0\0".join(coded) + b" \0\0\0", np.uint32)
    lengths = np.array([len(c) // 4 + 1 for c in coded], np.int64)
    begins = np.cumsum(lengths) - lengths
    script = script_of[points]
    low = lower_of[points]
    change = np.flatnonzero(np.diff(script)) + 1
    starts = np.concatenate([[0], change])
    ends = np.concatenate([change, [len(points)]])
    word = script[starts] > 0
    starts, ends = starts[word], ends[word]
    text = np.searchsorted(begins, starts, "right") - 1
    # Signs of a word: a mark, its letters, a mark; a trigram ends at each sign but the first.
    size = ends - starts + 1
    first = np.cumsum(size) - size
    within = np.arange(int(size.sum())) - np.repeat(first, size)
    at = np.repeat(starts, size) + within
    last = within == np.repeat(size, size) - 1
    mark = np.uint32(0)
    sign = np.where(last, mark, low[np.minimum(at, len(low) - 1)])
    before = np.where(within >= 1, low[at - 1], mark)
    ahead = np.where(within >= 2, low[np.maximum(at - 2, 0)], mark)
    return Words(
        text, starts - begins[text], ends - begins[text], script[starts],
        _hash(ahead, before, sign, np.full(len(sign), 3)), _hash(ahead, before, np.full(len(sign), 2)), first,
    )


@dataclass
class Model:
    """Languages in order, log counts of trigrams and contexts (cell, language), and which
    languages are written in which script (script, language)."""

    languages: list[str]
    trigrams: np.ndarray
    contexts: np.ndarray
    candidates: np.ndarray

    def word_scores(self, words: Words) -> np.ndarray:
        """Log-likelihood of each word under each language, less that of its best one.

        The script of the word narrows the languages; a script no language was seen with
        leaves them all.
        """
        if not len(words.first):
            return np.zeros((0, len(self.languages)), np.float32)
        signs = self.trigrams[words.cell] - self.contexts[words.context]
        total = np.add.reduceat(signs, words.first, axis=0)
        allowed = self.candidates[words.script]
        allowed = allowed | ~allowed.any(axis=1, keepdims=True)
        total = np.where(allowed, total, -np.inf)
        total -= total.max(axis=1, keepdims=True)
        return np.maximum(total, -WORD_LIMIT).astype(np.float32)


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang", learn_from: Column | None = None
) -> Model:
    """Character trigram counts per language over all rows that may be learned from.

    A task keeps two arrays of ``CELLS`` counts per language and hands on what is not zero;
    sums have a fixed size.  Null languages and null texts are passed over.
    """
    rows = (docs if learn_from is None else docs.where(learn_from)).where(F.col(lang).isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for piece in pieces(batches, "text"):
            names = piece.column("lang").to_pylist()
            for _, owner, words in _read(byte_texts(piece.column("text")), 1):
                owners = owner[words.text]
                sign_owner = np.repeat(owners, np.diff(np.append(words.first, len(words.cell))))
                for name in set(names):
                    mine = np.array([n == name for n in names])
                    if name not in seen:
                        seen[name] = np.zeros(2 * CELLS + OTHER + 1, np.int64)
                    signs, whole = mine[sign_owner], mine[owners]
                    seen[name][:CELLS] += np.bincount(words.cell[signs], minlength=CELLS)
                    seen[name][CELLS : 2 * CELLS] += np.bincount(words.context[signs], minlength=CELLS)
                    letters = np.bincount(words.script[whole], (words.end - words.start)[whole], OTHER + 1)
                    seen[name][2 * CELLS :] += letters.astype(np.int64)
        for name, counts in seen.items():
            cell = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(cell), pa.string()), pa.array(cell, pa.int32()), pa.array(counts[cell], pa.int64())],
                names=["lang", "cell", "n"],
            )

    counts = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    counts = counts.mapInArrow(run, "lang string, cell int, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    found: dict[str, np.ndarray] = {}
    for row in counts.toLocalIterator():
        if row["lang"] not in found:
            if len(found) == MAX_LANGUAGES:
                raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
            found[row["lang"]] = np.zeros(2 * CELLS + OTHER + 1, np.float32)
        found[row["lang"]][row["cell"]] = row["n"]
    languages = sorted(found)
    table = np.stack([found[name] for name in languages], axis=1) if languages else np.zeros((2 * CELLS + OTHER + 1, 0), np.float32)
    scripts = table[2 * CELLS :]
    share = scripts / np.maximum(scripts.sum(axis=0, keepdims=True), 1)
    return Model(
        languages,
        np.log(table[:CELLS] + SMOOTH / LETTERS).astype(np.float32),
        np.log(table[CELLS : 2 * CELLS] + SMOOTH).astype(np.float32),
        share >= MIN_SHARE,
    )


def _strips(texts: list[bytes | None], limit: int) -> Iterator[tuple[int, bytes]]:
    """Texts with their numbers; one longer than ``limit`` is cut, at a blank if there is one."""
    for number, text in enumerate(texts):
        rest = text or b""
        while len(rest) > limit:
            cut = max(rest.rfind(b" ", 1, limit), rest.rfind(b"\n", 1, limit))
            if cut < 1:
                cut = limit
                while rest[cut] & 0xC0 == 0x80:
                    cut -= 1
            yield number, rest[:cut]
            rest = rest[cut:]
        yield number, rest


def _read(texts: list[bytes | None], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, Words]]:
    """Words of the texts, some strips at a time: code points before each strip, its text, words."""
    limit = max(1 << 16, PIECE_BYTES // max(1, width // 4))
    group, owner, size, shift, offsets = [], [], 0, 0, []
    last = -1
    for number, strip in _strips(texts, limit):
        if group and size + len(strip) > limit:
            yield np.array(offsets), np.array(owner), words_of(group)
            group, owner, offsets, size = [], [], [], 0
        shift = 0 if number != last else shift
        group.append(strip)
        owner.append(number)
        offsets.append(shift)
        size += len(strip)
        shift, last = shift + len(strip.decode()), number
    if group:
        yield np.array(offsets), np.array(owner), words_of(group)


def viterbi(scores: np.ndarray, counts: np.ndarray, switch: float) -> np.ndarray:
    """Best language of every word when each change between neighbours costs ``switch``.

    ``counts``: words of each text, in order.  All texts are stepped together, longest
    first, so a step handles the t-th word of every text that has one.
    """
    n, width = scores.shape
    labels = np.zeros(n, np.int16)
    if not n:
        return labels
    order = np.argsort(-counts, kind="stable")
    first = (np.cumsum(counts) - counts)[order]
    active = np.searchsorted(-counts[order], -np.arange(int(counts.max())), "left")
    back = np.zeros((n, width), np.int16)
    own = np.arange(width, dtype=np.int16)
    value = scores[first[: active[0]]].copy()
    state = np.zeros(len(order), np.int64)
    for t in range(1, len(active)):
        here = active[t]
        if here < len(value):
            state[here : len(value)] = value[here:].argmax(axis=1)
            value = value[:here]
        best = value.argmax(axis=1)
        entry = value[np.arange(here), best][:, None] - switch
        stay = value >= entry
        at = first[:here] + t
        back[at] = np.where(stay, own, best[:, None])
        value = np.where(stay, value, entry) + scores[at]
    state[: len(value)] = value.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        here = active[t]
        at = first[:here] + t
        labels[at] = state[:here]
        state[:here] = back[at, state[:here]]
    return labels


def _label(texts: list[bytes | None], model: Model, switch: float, spans: bool) -> list[tuple]:
    """(language, score, spans) of each text."""
    width = len(model.languages)
    if not width:
        return [(UNDECIDED, 0.0, [])] * len(texts)
    owner, start, end, scores = [], [], [], []
    for offset, number, words in _read(texts, width):
        owner.append(number[words.text])
        start.append(offset[words.text] + words.start)
        end.append(offset[words.text] + words.end)
        scores.append(model.word_scores(words))
    owner, start, end = (np.concatenate(x).astype(np.int64) for x in (owner, start, end))
    counts = np.bincount(owner, minlength=len(texts))
    labels = viterbi(np.concatenate(scores), counts, switch).astype(np.int64)
    letters = np.bincount(owner * width + labels, end - start, len(texts) * width).reshape(len(texts), width)
    total, best = letters.sum(axis=1), letters.argmax(axis=1)
    cuts = np.cumsum(counts)
    out = []
    for i in range(len(texts)):
        if not total[i]:
            out.append((UNDECIDED, 0.0, []))
            continue
        found = []
        if spans:
            a, b = cuts[i] - counts[i], cuts[i]
            edges = [a, *(np.flatnonzero(np.diff(labels[a:b])) + 1 + a).tolist(), b]
            found = [
                {"start": int(start[x]), "end": int(end[y - 1]), "lang": model.languages[labels[x]]}
                for x, y in zip(edges, edges[1:])
            ]
        out.append((model.languages[best[i]], float(letters[i, best[i]] / total[i]), found))
    return out


def identify(
    docs: DataFrame, model: Model, keep: list[str], text: str = "text", switch: float = SWITCH, spans: bool = True
) -> DataFrame:
    """The columns ``keep``, lang_pred, score and spans (start, end, lang) of every row.

    Spans count code points and cover the words from the first to the last letter; the
    language of a text is the one with most letters in its spans (ties: first by name) and
    the score its share of them.  A null text, one without a letter, and every text under a
    model without languages gives ``und``, 0 and no spans.  Texts are read whole; rows are
    only mapped over, so repeated rows and hot values of other columns change nothing.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    taken, back = carried(docs, keep)
    rows = docs.select(*taken)
    names = rows.columns
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", 2 * PIECE_BYTES):
            found = _label(byte_texts(piece.column("text")), shared.value, switch, spans)
            lang, score, parts = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in names), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(parts, span_type)],
                names=[*names, "lang_pred", "score", "spans"],
            )

    schema = [ddl(rows), "lang_pred string", "score double", "spans array<struct<start: bigint, end: bigint, lang: string>>"]
    found = docs.select(*taken, F.col(f"`{text}`").alias("text")).mapInArrow(run, ", ".join(schema))
    return found.select(*back, "lang_pred", "score", "spans")

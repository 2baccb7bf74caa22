"""Near-duplicate documents, repeated lines and benchmark passages, against brute force."""

import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumenframe.llm import decontam, linededup, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(items, joined):
    """Smallest member of each one's component."""
    label = {i: i for i in items}
    changed = True
    while changed:
        changed = False
        for a, b in joined:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


@settings(max_examples=40, deadline=None)
@given(st.text(max_size=80))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode("utf-8", "ignore")) % (1 << 64) == slow_fingerprint(text.encode("utf-8", "ignore").decode())


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 6), st.integers(1, 700), st.integers(0, 10**6))
def test_bit_planes_count_right(radius, n, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 62, 3)
    prints = base[rng.integers(0, 3, n)]
    for _ in range(4):
        prints = prints ^ (1 << rng.integers(0, 62, n))
    i, j = simhash.close_pairs(prints.astype(np.int64), radius)
    apart = np.bitwise_count(prints[:, None] ^ prints[None, :])
    want = np.argwhere(np.triu(apart <= radius, 1))
    assert sorted(zip(i.tolist(), j.tolist())) == want.tolist() or sorted(zip(i.tolist(), j.tolist())) == [tuple(x) for x in want.tolist()]


def near_texts():
    random.seed(5)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for g in range(12):
        base = random.choices(words, k=150)
        for _ in range(random.choice([1, 2, 9])):
            copy = list(base)
            for _ in range(random.choice([0, 0, 1, 2])):
                copy[random.randrange(150)] = random.choice(words)
            rows.append(" ".join(copy))
    return [None, "", " \n", "One", "one two", "", *rows, rows[0], rows[0]]


def check_components(spark, rows):
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    prints = {i: slow_fingerprint(t) for i, t in rows}
    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    label = groups(ids, links)
    assert sorted((r.doc_id, r.fp % (1 << 64), r.component_id) for r in found) == sorted((i, prints[i], label[i]) for i, _ in rows)


def test_components(spark):
    check_components(spark, list(enumerate(near_texts())))


def test_crowded_buckets_are_compared_in_parts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 2)
    monkeypatch.setattr(simhash, "TILE", 3)
    check_components(spark, list(enumerate(near_texts())))


def test_one_of_each_group(spark):
    rows = [(4, "a b c d", 1), (2, "A b c d", 2), (2, "A b c d", 3), (None, "x", 4), (None, None, 5), (9, "", 6), (None, "x", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp long").withColumns({"root": F.lit(1), "_c0": F.lit(0)})
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(2, "A b c d"), (None, "x"), (9, "")], key=str)
    assert simhash.keep_one(docs.limit(0)).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_banded_distance(spark):
    random.seed(9)
    pairs = [("", "é"), ("aé😀b", "aé😀b"), ("abc", ""), ("", "")]
    for _ in range(300):
        a = "".join(random.choices("abé😀", k=random.randrange(0, 12)))
        b = list(a)
        for _ in range(random.randrange(0, 5)):
            at = random.randrange(len(b) + 1)
            if random.random() < 0.5:
                b.insert(at, random.choice("abé"))
            elif b:
                b.pop(at % len(b))
        pairs.append((a, "".join(b)))
    frame = spark.createDataFrame(pairs, "a string, b string")
    # The operator never asks about an empty longer line.
    frame = frame.where("b != ''")
    for threshold in (1, 2, 3):
        got = frame.withColumn("near", linededup.within(F.col("a"), F.col("b"), threshold)).collect()
        assert [r.near for r in got] == [edits(r.a, r.b) <= threshold for r in got]


def slow_lines(rows, threshold, shortest):
    """Text left of every document when a line goes that stood before or is late and near."""
    places = sorted({(i, n, line) for i, t in rows for n, line in enumerate((t or "").split("\n")) if line and t is not None}, key=lambda p: p[:2])
    first = {}
    for i, n, line in places:
        first.setdefault(line, (i, n))
    late = {
        b for b in first for a in first
        if first[a] < first[b] and min(len(a), len(b)) >= shortest and abs(len(a) - len(b)) <= threshold and edits(a, b) <= threshold
    }
    out = {}
    for i, t in rows:
        if t is None:
            out[i] = None
        else:
            out[i] = "\n".join(x for n, x in enumerate(t.split("\n")) if not x or (first[x] == (i, n) and x not in late))
    return out


def line_rows():
    random.seed(2)
    base = ["".join(random.choices("abcé ", k=random.randrange(4, 40))) for _ in range(25)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(random.randrange(0, 8)):
            line = list(random.choice(base))
            for _ in range(random.choice([0, 0, 1, 1, 2])):
                at = random.randrange(len(line))
                kind = random.randrange(3)
                line[at : at + (kind < 2)] = random.choice("xyz") if kind else ""
            lines.append("".join(line))
        rows.append((i, "\n".join(lines)))
    return [*rows, (50, None), (51, ""), (52, "\n\n"), (53, "same\nsame\n\nsame")]


def check_lines(spark, rows, threshold):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"gone": F.lit(1), "id": F.lit("x"), "_c1": F.lit(2)})
    got = linededup.dedup_lines(docs, threshold=threshold, shortest=8)
    assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect()} == slow_lines(rows, threshold, 8)


def test_lines_at_one_edit(spark):
    check_lines(spark, line_rows(), 1)


def test_lines_at_two_edits(spark):
    check_lines(spark, line_rows(), 2)


def test_crowded_segments(spark, monkeypatch):
    monkeypatch.setattr(linededup, "CROWD", 1)
    check_lines(spark, line_rows(), 1)


def test_lines_of_repeated_rows_and_null_ids(spark):
    rows = [(None, "b line"), (3, "b line\nkeep"), (3, "b line\nkeep"), (3, "other\nkeep")]
    got = [(r.doc_id, r.text) for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    # Rows that agree are one document; of two texts with one id the order of their hashes decides.
    assert (None, "b line") in got and got.count((3, "keep")) + got.count((3, "")) in (2, 3)
    assert linededup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def slow_hits(text, items, span):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    words, hit, found = split(text), set(), set()
    for item, t in items:
        w = split(t)
        m = min(len(w), span)
        for s in range(len(w) - m + 1) if m else ():
            for i in range(len(words) - m + 1):
                if words[i : i + m] == w[s : s + m]:
                    hit |= set(range(i, i + m))
                    found.add(item)
    return len(words), hit, found


@settings(max_examples=120, deadline=None)
@given(
    st.lists(st.text("ab .é", max_size=40), min_size=1, max_size=5),
    st.lists(st.text("ab .é", max_size=60), min_size=1, max_size=4),
)
def test_every_window_is_found(items, texts):
    named = list(enumerate(items))
    index = decontam.Index([(i, t.encode()) for i, t in named], span=4, k=3)
    for text in texts:
        n, ranges, found = index.hits(text.encode())
        assert (n, {w for a, b in ranges for w in range(a, b)}, found and {index.ids[t] for t in found} or set()) == slow_hits(text, named, 4)


def test_benchmark_in_blocks(spark):
    random.seed(4)
    words = [f"v{k}" for k in range(400)]
    items = [(i, " ".join(random.choices(words, k=random.choice([0, 3, 9, 10, 40])))) for i in range(20)] + [(99, None), (None, "only this one")]
    rows = []
    for i in range(60):
        text = random.choices(words, k=random.randrange(0, 60))
        for _ in range(random.randrange(0, 3)):
            w = (random.choice(items[:20])[1] or "").split()
            at = random.randrange(max(1, len(w) - 11))
            text[random.randrange(len(text) + 1) : 0] = w[at : at + random.choice([9, 10, 25])]
        rows.append((i, " ".join(text)))
    rows += [(70, None), (71, ""), (72, "Only THIS one"), (1, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"spans": F.lit(1), "_c0": F.lit(2)})
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (10**6, 50):
        found = decontam.contamination(docs, bench, block_words=limit).collect()
        assert len(found) == len(rows)
        for r in found:
            n, hit, names = slow_hits(dict(rows)[r.doc_id], items, 10)
            assert (r.n_words, sorted(str(x) for x in names if x is not None)) == (n, r["items"])
            assert {w for s in r.spans for w in range(s.start, s.end)} == hit
        clean = decontam.clean(docs, bench, block_words=limit)
        assert clean.columns == docs.columns
        assert clean.count() == sum(not slow_hits(t, items, 10)[1] for _, t in rows)
    assert decontam.contamination(docs.limit(0), bench).count() == 0
    assert decontam.clean(docs, bench.limit(0)).count() == len(rows)

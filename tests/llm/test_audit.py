"""Filter audit: the transducer against plain counting, the table against every order played through."""

import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.llm import audit

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def by_hand(text):
    text = text or b""
    words = WORD.findall(text)
    return [
        len(words), len(set(words)), len(re.findall(rb"[A-Z]", text)), len(re.findall(rb"[\x00-\x7f\xc0-\xff]", text)),
        len(re.findall(rb"[#$%&*|]", text)),
    ]


def check(texts):
    found = audit.measure_texts(texts)
    assert [[int(found[m][i]) for m in audit.MEASURES] for i in range(len(texts))] == [by_hand(t) for t in texts]


@pytest.mark.parametrize("strip", [7, 64, 1 << 15])
def test_strips_of_any_size(monkeypatch, strip):
    monkeypatch.setattr(audit, "STRIP", strip)
    rng = random.Random(strip)
    long = b"x" * 70 + b" " + b"x" * 69 + b"y " + b"x" * 70
    for _ in range(150):
        texts = []
        for _ in range(rng.randrange(6)):
            n = rng.choice([0, 1, 5, 63, 64, 65, 300])
            mixed = bytes(rng.choice("ab AB\n\t#é\x1c\x85".encode()) for _ in range(n))
            texts.append(rng.choice([None, mixed, b"a" * n, b" " * n, (b"word " * n)[:n], long]))
        check(texts)


def test_long_texts_and_many_words():
    check([b"q" * 100_000 + b" " + b"q" * 100_000 + b" " + b"q" * 99_999, b"ab " * 50_000, None, b""])
    check([b" ".join(b"%d" % (i % 30_000) for i in range(60_000)), "é ".encode() * 1000])


def test_equal_hashes_are_verified(monkeypatch):
    """Whatever the hash: here all words have the same one."""
    insert = audit.Spans.insert
    monkeypatch.setattr(audit.Spans, "insert", lambda self, key, *rest: insert(self, np.zeros_like(key), *rest))
    check([b"a b c a b d " * 3, b"a b", b"w" * 80 + b" " + b"w" * 79 + b"v " + b"w" * 80])


def test_every_order_played_through(spark):
    rng = random.Random(3)
    texts = [None, "", "plain words here", "MANY CAPS", "a | b", "again again again again", " ".join(f"w{i}" for i in range(250)), "x " * 300]
    rows = [(i if rng.random() < 0.9 else None, rng.choice(texts), rng.choice(["s", "t", None, ""])) for i in range(150)]
    rows += rows[:20]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"n": F.lit(1), "mask": F.lit(2), "digest": F.lit(3)})
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(2, 1, 1), (None, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {(r.part, r.filter_order, r.step): r for r in audit.audit(docs, table).collect()}

    def fails(i, text):
        text = text or ""
        words = WORD.findall(text.encode())
        same = [j for j, t, _ in rows if j is not None and (t or "") == text]
        out = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        out += "C" * (100 * len(re.findall("[A-Z]", text)) > 2 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
        return out + "E" * (i is not None and bool(same) and min(same) < i)

    good, toxic = ({i for i, *marks in labels if i is not None and marks[k] == 1} for k in (0, 1))
    failing = [(i, s or "", fails(i, t)) for i, t, s in rows]
    assert len(found) == 600 * len({s for _, s, _ in failing})
    shapley = {}
    for part in {s for _, s, _ in failing}:
        own = [(i, f) for i, s, f in failing if s == part]
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                here = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                r = found[part, "".join(order), step]
                assert (r.kept, r.removed) == (len(left), len(here))
                assert r.redundant == sum(name in f for _, f in own) - len(here)
                assert r.unique_fails == sum(f == name for _, f in own)
                assert (r.good_lost, r.toxic_lost) == (sum(i in good for i, _ in here), sum(i in toxic for i, _ in here))
                shapley[part, name] = shapley.get((part, name), 0) + len(here)
    assert all(r.shapley == shapley[part, order[step - 1]] for (part, order, step), r in found.items())


def test_empty_tables_and_other_filters(spark):
    docs = spark.createDataFrame([(1, "AB c", "s"), (2, "d", "s")], "doc_id long, text string, source string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(docs.limit(0), none).count() == 0
    found = audit.audit(docs, none, {"X": F.col("n_capitals") > 1, "Y": F.col("n_words") < 2}).collect()
    got = sorted((r.filter_order, r.step, r.kept, r.removed, r.shapley) for r in found)
    assert got == [("XY", 1, 1, 1, 2), ("XY", 2, 0, 1, 2), ("YX", 1, 1, 1, 2), ("YX", 2, 0, 1, 2)]
    with pytest.raises(ValueError):
        audit.audit(docs, none, {})


def test_measures_keep_columns(spark):
    docs = spark.createDataFrame([(1, "A b b", 7)], "doc_id long, text string, n_words int")
    row = audit.measure(docs, ["doc_id", "text"]).first()
    assert tuple(row) == (1, "A b b", 3, 2, 1, 5, 0)

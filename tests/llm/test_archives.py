"""WARC archives, chat logs and mixing."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumenframe.llm import chat, mixing, warc

PAGE = "page_id long, url string, html string"


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9)), max_size=9))
def test_loser_tree_merges(runs):
    streams = [iter([((x,), (r, i)) for i, x in enumerate(sorted(run))]) for r, run in enumerate(runs)]
    got = list(warc.LoserTree(streams))
    assert [k[0] for k, _ in got] == sorted(x for run in runs for x in run)
    for r, run in enumerate(runs):
        assert [i for _, (s, i) in got if s == r] == list(range(len(run)))


def pages():
    random.seed(6)
    long = "<p>" + "x" * 200
    rows = [(i, f"HTTP://www.Example{i % 3}.org:80/a?b={i}&a=1", random.choice([long, long + "é", "short", f"{i}\r\n\r\nWARC/1.1\r\n" + "y" * 90])) for i in range(60)]
    return rows + [(70, None, None), (71, "http://[bad", ""), (72, "a\r\nb: c", long), (None, "http://z.org", long), (5, rows[5][1], rows[5][2])]


@pytest.mark.parametrize("ranges", [10**6, 7])
def test_archives_round_trip(spark, monkeypatch, ranges):
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 4)
    monkeypatch.setattr(warc, "RANGE_ROWS", ranges)
    monkeypatch.setattr(warc, "CHUNK_ROWS", 2)
    monkeypatch.setattr(warc, "KEYS_PER_RANGE", 7)
    rows = pages()
    frame = spark.createDataFrame(rows, PAGE).withColumns({"digest": F.lit(1), "payload": F.lit(2)}).repartition(3)
    index = warc.archive_and_index(frame, captured=F.timestamp_seconds(F.coalesce(F.col("page_id") % 7, F.lit(0)))).collect()
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    want = sorted(
        (str(i), len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(),
         *(("revisit", first[h]) if h in first and first[h] != i else ("response", None)))
        for i, _, h in rows
    )
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in index) == want
    order = [(r.url_key, r.date, warc._id_key(None if r.page_id is None else str(r.page_id)), r.archive, r.offset) for r in sorted(index, key=lambda r: (r.part, r.place))]
    assert order == sorted(order)
    assert (len({r.part for r in index}) > 3) == (ranges == 7)


def test_no_pages(spark):
    assert warc.archive_and_index(spark.createDataFrame([], PAGE)).count() == 0


def test_url_keys():
    assert warc.url_key("https://WWW.Example.com:443/Path?b=2&a=1#x") == "com,example)/path?a=1&b=2"
    assert warc.url_key("http://a.b:8080") == "b,a:8080)/"
    assert warc.url_key(None) == "" and warc.url_key("http://[bad") == "http://[bad"


LOG = "conv_id long, turn long, role string, text string"


def talk(conv, *texts):
    return [(conv, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]


def test_maximal_conversations(spark):
    rows = talk(1, "a", "b") + talk(2, "a", "b", "c") + talk(3, "a", "b", "c") + talk(4, "a", "x") + talk(5, "a")
    rows += talk(6, "b") + talk(7, "ab") + [(8, 0, None, "n"), (8, None, None, None), (None, 0, "user", "q"), (9, 0, "user", "q")]
    rows += talk(2, "a")  # an exactly repeated turn
    log = spark.createDataFrame(rows, LOG).withColumns({"bucket": F.lit(1), "p1": F.lit(2)})
    conversations, turns = chat.collapse(log)
    fate = {r.conv_id: r.fate for r in conversations.collect()}
    assert fate == {1: "prefix", 2: "kept", 3: "copy", 4: "kept", 5: "prefix", 6: "kept", 7: "kept", 8: "kept", None: "copy", 9: "kept"}
    text = {r.conv_id: r.rendered for r in chat.render(turns).collect()}
    assert text[2] == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n<|im_start|>user\nc<|im_end|>\n"
    assert text[8] == "<|im_start|>unknown\n<|im_end|>\n<|im_start|>unknown\nn<|im_end|>\n"
    assert set(text) == {k for k, v in fate.items() if v == "kept"}


def test_long_conversations_in_buckets_and_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "BUCKET_TURNS", 4)
    monkeypatch.setattr(chat, "PART_TURNS", 5)
    texts = [str(i * i) for i in range(33)]
    rows = talk(1, *texts) + talk(2, *texts[:20]) + talk(3, *texts[:20], "other") + talk(4, *texts) + talk(5, *reversed(texts))
    random.seed(1)
    random.shuffle(rows)
    conversations, turns = chat.collapse(spark.createDataFrame(rows, LOG))
    assert {r.conv_id: r.fate for r in conversations.collect()} == {1: "kept", 2: "prefix", 3: "kept", 4: "copy", 5: "kept"}
    parts = sorted((r.conv_id, r.part, r.n_turns, r.rendered) for r in chat.render(turns).collect())
    whole = "".join(f"<|im_start|>{'user' if i % 2 == 0 else 'assistant'}\n{t}<|im_end|>\n" for i, t in enumerate(texts))
    assert "".join(p[3] for p in parts if p[0] == 1) == whole and max(p[2] for p in parts) == 5


def test_empty_log(spark):
    conversations, turns = chat.collapse(spark.createDataFrame([], LOG))
    assert conversations.count() == 0 and chat.render(turns).count() == 0


DOCS = "doc_id long, text string, source string, lang string"


def documents():
    random.seed(8)
    rows = []
    for i in range(400):
        n = random.choice([3, 30, 500])
        rows.append((i, " ".join(random.choices(["a", "b", "|", "c!"], [9, 9, random.choice([0, 9]), 1], k=n)), random.choice(["s0"] * 9 + ["s1", "s2", None]), random.choice(["en", "en", "fr", None])))
    return rows


def test_rates_meet_every_target(spark):
    docs = spark.createDataFrame(documents(), DOCS).withColumns({"rate": F.lit("old"), "topic": F.lit("t"), "_c0": F.lit(1)})
    margins = {
        "m1": mixing.Margin(F.col("source"), named={"s1": 0.3, "s2": 0.2, "gone": 0.1}),
        "m2": mixing.Margin(F.col("lang"), power=0.0),
        "m3": mixing.Margin(F.col("topic")),
    }
    out = mixing.mixed(docs, margins=margins, share=0.5).collect()
    assert len(out) == 400
    total = sum(r.n_words for r in out)
    drawn = lambda keep: sum(r.n_words * r.rate for r in out if keep(r)) / (0.5 * total)
    assert drawn(lambda r: True) == pytest.approx(1)
    # Shares of sources without tokens fall to the others: 0.9 is left of the whole.
    assert drawn(lambda r: r.source == "s1") == pytest.approx(0.3 / 0.9) and drawn(lambda r: r.source == "s2") == pytest.approx(0.2 / 0.9)
    assert [drawn(lambda r, k=k: r.lang == k) for k in ("en", "fr", None)] == pytest.approx([1 / 3] * 3)
    assert all(int(r.rate) <= r.copies <= int(r.rate) + 1 for r in out)
    assert sum(r.copies for r in out) == pytest.approx(sum(r.rate for r in out), rel=0.2)


def test_forms_nulls_and_repeats(spark):
    rows = [(1, None, "s", "en"), (2, "", "s", "en"), (3, "plain words", "s", "en"), (3, "plain words", "s", "en"), (4, "a | b", "s", None),
            (5, "HEY!! YOU!!", None, "en"), (6, "w " * 400, "s", "en"), (None, "no id here", "s", "en")]
    frame = spark.createDataFrame(rows, DOCS)
    forms = frame.select("doc_id", mixing.text_form(F.coalesce("text", F.lit("")), mixing.word_count(F.col("text"))).alias("f")).collect()
    assert {r.doc_id: r.f for r in forms} == {1: "empty", 2: "empty", 3: "short", 4: "table", 5: "shout", 6: "long", None: "short"}
    margins = {"m": mixing.Margin(F.col("source"), 0.5), "n": mixing.Margin(F.col("lang"), 0.7)}
    out = mixing.mixed(frame, margins=margins).collect()
    assert len(out) == len(rows) and all(r.copies == 0 for r in out if r.doc_id in (1, 2))
    assert len({(r.rate, r.copies) for r in out if r.doc_id == 3}) == 1
    assert mixing.mixed(frame.limit(0)).count() == 0


def test_targets_that_cannot_be_met(spark):
    rows = [(1, "a b", "s0", "en"), (2, "a b", "s1", "fr")]
    margins = {"m": mixing.Margin(F.col("source"), named={"s0": 0.9, "s1": 0.1}), "n": mixing.Margin(F.col("lang"), named={"en": 0.1, "fr": 0.9})}
    mix = mixing.rake(spark.createDataFrame(rows, DOCS), margins, mixing.word_count(F.col("text")), max_rounds=3)
    assert not mix.converged and mix.rounds == 3 and mix.error > 0.5

"""Nested elements of the same name."""

import random
import re

from lumenframe import sources as S


def by_hand(html, tag):
    """Brackets matched on a stack; elements in the order of their opening tags."""
    stack, found = [], []
    for m in re.finditer(rf"(?is)<{tag}(?:\s[^>]*)?>|</{tag}\s*>", html):
        if not m.group().startswith("</"):
            stack.append(m.start())
        elif stack:
            found.append((stack.pop(), m.end()))
    return [re.sub(r"(?s)<[^>]*>", "", html[a:b]) for a, b in sorted(found)]


def test_nested_elements(spark):
    rng = random.Random(1)
    pages = [
        '<div class="a">one <div>two</div> three</div>', "<div>open <div>closed</div>", "</div><div>x</div></div>", "", None, "no tags",
        "<DIV a='1'>\nline</DIV ><divx>no</divx>", "<div></div><div><div></div></div>",
    ]
    pages += ["".join(rng.choices(["<div>", '<div class="k">', "</div>", "a", " b\n", "<p>c</p>"], k=rng.randrange(25))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    got = {}
    for r in S.extract_elements(df, "page_id", "html", "div").collect():
        got.setdefault(r.page_id, []).append((r.pos, r.text))
    for i, html in enumerate(pages):
        assert [t for _, t in sorted(got.get(i, []))] == by_hand(html or "", "div")
        assert [p for p, _ in sorted(got.get(i, []))] == list(range(len(got.get(i, []))))


def test_classes_and_attributes_of_nested_elements(spark):
    html = '<div class="outer" id="1">a<div class="inner" id="2">b<span>c</span></div>d</div>'
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    rows = S.extract_elements(df, "page_id", "html", "div", "inner", "id").collect()
    assert [(r.pos, r.text, r.id) for r in rows] == [(0, "bc", "2")]
    rows = S.extract_elements(df, "page_id", "html", "div", attribute="id").collect()
    assert [(r.pos, r.text, r.id) for r in rows] == [(0, "abcd", "1"), (1, "bc", "2")]

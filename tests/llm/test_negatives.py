"""Hard negatives against plain enumeration."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def relabelled():
    label = F.col("label").cast("long")
    return F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)


def mined(df, **more):
    found = negatives.mine(df, F.col("vec_id") % 100 == 0, relabelled(), **more).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in found)


def by_hand(rows):
    clean = []
    for i, v, label in dict.fromkeys((i, None if v is None else tuple(v), label) for i, v, label in rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        clean.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = []
    for a, av, al in clean:
        if a is None or a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(av, v)), math.inf if i is None else i, i, label) for i, v, label in clean if i != a and len(v) == len(av)]
        scored.sort(key=lambda s: s[:2])
        for p, _, pid, _ in [s for s in scored if s[3] == al][:5]:
            fit = [s for s in scored if s[3] != al and 30 * -p <= 100 * -s[0] <= 90 * -p][:10]
            out += [(a, pid, k, s[2], -p, -s[0]) for k, s in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("size", ["one", "many"])
def test_same_as_enumeration(spark, monkeypatch, size):
    if size == "many":
        monkeypatch.setattr(negatives, "PART_ROWS", 40)
        monkeypatch.setattr(negatives, "PART_ANCHORS", 2)
        monkeypatch.setattr(negatives, "SCORES", 64)
    rng = np.random.default_rng(1)
    hot = rng.standard_normal(6).tolist()
    rows = [(i, hot if i % 3 == 0 else rng.standard_normal(6).tolist(), int(rng.integers(0, 4))) for i in range(700)]
    # Whole vectors in few values give many ties.
    rows += [(i, rng.integers(-2, 3, 6).astype(float).tolist(), int(rng.integers(0, 3))) for i in range(700, 1200)]
    df = spark.createDataFrame(rows + rows[:30], SCHEMA).withColumns({"dims": F.lit(1), "part": F.lit(2), "asks": F.lit(3)})
    got = mined(df)
    assert got == by_hand(rows) and len(got) > 100


def test_rows_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [1.5, 0.0], 1), (2, [0.5, 0.1], 2), (None, [0.6, 0.0], 3), (3, [0.6, 0.0], 4), (4, None, 2), (5, [0.5, None], 2),
            (6, [float("nan"), 1.0], 2), (8, [float("inf"), 1.0], 2), (9, [1.0, 1.0], None), (10, [0.9], 2), (11, [], 2), (100, [], 5), (12, [1e308, 1.0], 2)]
    got = mined(spark.createDataFrame(rows, SCHEMA))
    assert got == by_hand([r for r in rows if r[0] != 12]) and {g[3] for g in got} == {2, 3, None}


def test_windows_of_low_positives(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 1), (2, [-1.0, 0.0], 1), (3, [0.0, 3.0], 2), (4, [-0.5, 0.0], 2), (5, [0.001, 0.0], 2), (100, [-1.0, 0.0], 3)]
    got = mined(spark.createDataFrame(rows, SCHEMA))
    assert got == by_hand(rows) == [(0, 1, 1, 3, 0, 0), (0, 1, 2, 5, 0, 0)]
    assert mined(spark.createDataFrame(rows[:1], SCHEMA)) == [] and mined(spark.createDataFrame(rows[1:6], SCHEMA)) == []
    assert mined(spark.createDataFrame([], SCHEMA)) == []


def test_large_components_stay_exact(spark):
    def rows(big):
        return [(0, [big, 1.0], 0), (1, [big, 3.0], 1), (2, [big / 2, 1.0], 2), (3, [big / 2, 1.00390625], 2), (5, [0.5, 1.0], 2)]

    got = mined(spark.createDataFrame(rows(2.0**22), SCHEMA))
    assert got == by_hand(rows(2.0**22)) and [g[3] for g in got] == [3, 2]
    # All scores stand at the limit of a long, so none is below 90 % of another.
    assert mined(spark.createDataFrame(rows(2.0**40), SCHEMA)) == []
    left, right = np.array([[2.0**60, 3.0], [1.0, 2.0]]), np.array([[2.0, 1.0], [2.0**60, 5.0]])
    got = negatives.inner_products(left, right)
    assert got.tolist() == [[2**61 + 3, negatives.LONG], [4, 2**60 + 10]]
    assert negatives.inner_products(np.zeros((2, 0)), np.zeros((3, 0))).tolist() == [[0, 0, 0], [0, 0, 0]]


def test_ids_with_several_rows(spark):
    rows = [(0, [1.0, 0.0], 0), (0, [5.0, 0.0], 0), (1, [2.0, 0.0], 1), (2, [1.0, 0.0], 2), (2, [1.5, 0.0], 2)]
    # The least of the anchor's rows asks; none of them is compared with it.
    assert mined(spark.createDataFrame(rows, SCHEMA)) == [(0, 1, 1, 2, 131072, 98304), (0, 1, 2, 2, 131072, 65536)]


def test_other_settings(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, rng.standard_normal(3).tolist(), int(rng.integers(0, 3))) for i in range(200)], SCHEMA)
    found = mined(df, positives=2, negatives=1, low=0, high=100)
    assert found and all(f[2] == 1 and 0 <= f[5] <= f[4] for f in found) and len({f[:2] for f in found}) == len(found)
    with pytest.raises(ValueError):
        mined(df, low=50, high=40)

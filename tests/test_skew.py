"""One value, key or group holding a third of all rows must not change any result."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lumenframe.functions import special
from lumenframe.operators import baskets, ols, profile, ranking, tuning, udfs
from lumenframe.operators import metrics as M
from lumenframe.operators.ordering import top_per_group
from lumenframe.runtime import lookup


@pytest.fixture(scope="module")
def hot(spark):
    """9,000 rows: key 0 and value 5.0 hold a third each."""
    rng = np.random.default_rng(0)
    n = 9000
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "k": np.where(np.arange(n) % 3 == 0, 0, rng.integers(1, 40, n)),
            "v": np.where(rng.random(n) < 1 / 3, 5.0, np.round(rng.normal(5, 3, n), 2)),
            "w": rng.normal(0, 1, n),
        }
    )
    return spark.createDataFrame(pdf).repartition(8), pdf


def test_large_lookup_is_never_broadcast(spark):
    """The planner takes these few bytes of ids for a table to broadcast, copies and all."""
    ids = spark.range(50).withColumnRenamed("id", "k")
    plan = lookup(ids, ids.withColumn("name", F.lit("n")), ["k"], max_rows=3)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_quantiles(hot):
    df, pdf = hot
    got = {r["k"]: r for r in ranking.exact_quantiles(df, ["k"], "v", {"a": 0.1, "b": 0.5, "c": 0.97}).collect()}
    for k, g in pdf.groupby("k"):
        want = np.quantile(g["v"], [0.1, 0.5, 0.97])
        assert np.allclose([got[k]["a"], got[k]["b"], got[k]["c"]], want)


def test_ranks_and_attach(hot):
    df, pdf = hot
    ranks = ranking.average_rank(df, [], "v").select("v", "n", "avg_rank")
    rows = ranking.attach_by_value(df, ranks, "v", parts=4).toPandas().sort_values("id")
    assert len(rows) == len(pdf)
    assert np.allclose(rows["avg_rank"], pdf["v"].rank())


def test_null_keys_are_kept(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "k string, v double")
    got = {r["k"]: r["m"] for r in ranking.exact_quantiles(df, ["k"], "v", {"m": 0.5}).collect()}
    assert got == {None: 2.0, "a": 2.0}


def test_ordinal(hot):
    df, pdf = hot
    rows = ranking.ordinal(df, ["k"], "id").toPandas().sort_values("id")
    assert (rows["ordinal"].to_numpy() == pdf.groupby("k").cumcount().to_numpy()).all()


def test_contiguous_folds(spark):
    for n, k in ((23, 5), (20, 5), (3, 5)):
        got = tuning.contiguous_folds(spark.range(n).toDF("i"), "i", k).orderBy("i").toPandas()["fold"]
        want = np.concatenate([np.full(len(p), i) for i, p in enumerate(np.array_split(np.arange(n), k))])
        assert got.tolist() == want.tolist()


def test_spearman(hot):
    df, pdf = hot
    got = {r["feature"]: r["rho"] for r in profile.spearman_with(df, "v", ["w", "k"]).collect()}
    want = pdf[["v", "w", "k"]].rank().corr()
    assert got["w"] == pytest.approx(want.loc["v", "w"], abs=1e-12)
    assert got["k"] == pytest.approx(want.loc["v", "k"], abs=1e-12)


def test_lookup_salted_equals_broadcast(hot, spark):
    df, pdf = hot
    names = spark.createDataFrame([(int(k), f"n{k}") for k in range(0, 30)], "k bigint, name string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        a = lookup(df, names, ["k"], how).select("id", "k").toPandas().sort_values("id")
        b = lookup(df, names, ["k"], how, max_rows=3).select("id", "k").toPandas().sort_values("id")
        assert a["id"].tolist() == b["id"].tolist()
    assert len(lookup(df, names, ["k"], max_rows=3).where("name = 'n0'").collect()) == (pdf["k"] == 0).sum()


def test_top_per_group(hot):
    df, pdf = hot
    got = top_per_group(df, ["k"], [F.desc("w"), F.col("id")], 3).toPandas()
    want = pdf.sort_values(["k", "w"], ascending=[True, False]).groupby("k").head(3)
    assert sorted(got["id"]) == sorted(want["id"])


def test_user_aggregate(hot):
    df, pdf = hot
    got = udfs.reduce_groups(
        df.select("k", "v"),
        ["k"],
        {"total": "double", "n": "bigint"},
        lambda g: {"total": g["v"].sum(), "n": len(g)},
        lambda g: {"total": g["total"].sum(), "n": g["n"].sum()},
    ).toPandas().set_index("k").sort_index()
    want = pdf.groupby("k")["v"].agg(["sum", "count"])
    assert np.allclose(got["total"], want["sum"]) and (got["n"] == want["count"]).all()


def test_user_aggregate_calls_each_key_once(spark, monkeypatch):
    """Every task of the input holds every key: partial rows of each would be 8 x 50; a hot key is spread."""
    df = spark.range(4000).select(F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v")).repartition(8)
    calls = spark.sparkContext.accumulator(0)

    def total(g):
        calls.add(1)
        return {"total": g["v"].sum()}

    def run():
        before = calls.value
        rows = udfs.reduce_groups(df, ["k"], {"total": "bigint"}, total, lambda g: {"total": g["total"].sum()}).collect()
        return {r["k"]: r["total"] for r in rows}, calls.value - before

    want = {k or None: sum(range(k, 4000, 50)) for k in range(50)}
    assert run() == (want, 50)
    monkeypatch.setattr(udfs, "HELD_ROWS", 10)
    got, calls_of_parts = run()
    assert got == want and calls_of_parts > 50


@pytest.mark.parametrize("width", [2, 6])
def test_grouped_least_squares(spark, width):
    rng = np.random.default_rng(1)
    n = 3000
    x = rng.normal(1000, 2, (n, width))
    g = np.where(np.arange(n) % 3 == 0, 0, rng.integers(1, 5, n))
    y = x @ np.arange(1, width + 1) + g + rng.normal(0, 0.1, n)
    names = [f"x{i}" for i in range(width)]
    pdf = pd.DataFrame(x, columns=names).assign(g=g, y=y)
    for r in ols.fit(spark.createDataFrame(pdf).repartition(5), "y", names, ["g"]).collect():
        a = np.column_stack([x[g == r["g"]], np.ones((g == r["g"]).sum())])
        want, *_ = np.linalg.lstsq(a - np.append(a[:, :-1].mean(0), 0), y[g == r["g"]], rcond=None)
        assert np.allclose(r["coef"], want[:-1], rtol=1e-8)
        rest = y[g == r["g"]] - a[:, :-1] @ r["coef"] - r["intercept"]
        assert abs(rest.mean()) < 1e-6
        s2 = rest @ rest / (len(a) - width - 1)
        centred = a[:, :-1] - a[:, :-1].mean(0)
        assert np.allclose(r["se"][:-1], np.sqrt(s2 * np.diag(np.linalg.inv(centred.T @ centred))), rtol=1e-6)


def test_area_under_roc(spark):
    rows = [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)]
    df = spark.createDataFrame(rows, "s double, y int")
    assert M.area_under_roc(df, "s", F.col("y") == 1).first()["auc"] == pytest.approx(0.75)
    sure = df.withColumn("s", F.col("y") + 0.5)
    assert M.area_under_roc(sure, "s", F.col("y") == 1).first()["auc"] == 1.0


def test_five_baskets(spark):
    df = spark.createDataFrame([(x.split(),) for x in ("a b c", "a b", "a c", "b c", "a b c a")], "items array<string>")
    sets = baskets.frequent_itemsets(df, "items", 0.4)
    found = {"".join(r["items"]): r["support"] for r in sets.collect()}
    assert found == pytest.approx({"a": 0.8, "b": 0.8, "c": 0.8, "ab": 0.6, "ac": 0.6, "bc": 0.6, "abc": 0.4})
    rules = {("".join(r["lhs"]), "".join(r["rhs"])): r for r in baskets.association_rules(sets, 0.5).collect()}
    assert rules[("a", "b")]["confidence"] == pytest.approx(0.75)
    assert rules[("a", "bc")]["confidence"] == pytest.approx(0.5)
    assert rules[("ab", "c")]["lift"] == pytest.approx(0.4 / 0.6 / 0.8)
    assert len(rules) == 12


def test_tail_probabilities():
    assert special.chi2_tail(8.285891, 9) == pytest.approx(0.505612, abs=1e-6)
    assert special.chi2_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert special.chi2_tail(200.0, 2) == pytest.approx(np.exp(-100), rel=1e-2, abs=1e-14)
    assert special.f_tail(1.0, 7, 7) == pytest.approx(0.5, abs=1e-12)
    assert special.f_tail(4.0, 1, 10) == pytest.approx(special.student_two_sided(np.array([2.0]), 10)[0], rel=1e-10)
    assert special.student_two_sided(np.array([2.228138851964939]), 10)[0] == pytest.approx(0.05, abs=1e-9)


# The published counts of the linear digit classifier; rows are the
# predicted digit and columns the true one, so the published per-class shares are recall.
DIGITS = [
    [608, 0, 4, 1, 0, 3, 3, 1, 4, 1],
    [0, 666, 7, 10, 5, 5, 0, 6, 11, 4],
    [4, 2, 556, 15, 6, 1, 7, 5, 8, 2],
    [1, 3, 7, 541, 0, 18, 0, 3, 16, 13],
    [0, 1, 8, 2, 544, 5, 4, 4, 3, 21],
    [3, 5, 1, 24, 1, 431, 6, 1, 19, 3],
    [3, 0, 8, 2, 5, 11, 559, 0, 5, 0],
    [0, 3, 7, 5, 1, 4, 0, 559, 4, 19],
    [3, 8, 10, 12, 3, 12, 4, 2, 491, 3],
    [1, 1, 3, 4, 20, 1, 0, 24, 8, 517],
]


def test_published_confusion(spark):
    cells = spark.createDataFrame(
        [(j, i, int(n)) for i, row in enumerate(DIGITS) for j, n in enumerate(row)],
        "label int, prediction int, n bigint",
    )
    assert M.accuracy(cells).first()["accuracy"] == pytest.approx(0.9188916876574307, abs=1e-15)
    per = {r["label"]: r for r in M.by_label(cells).collect()}
    assert per[0]["recall"] == pytest.approx(0.9759229534510433, abs=1e-15)
    assert per[8]["recall"] == pytest.approx(0.8629173989455184, abs=1e-15)
    assert per[0]["precision"] == pytest.approx(608 / 625)
    assert per[0]["support"] == 623

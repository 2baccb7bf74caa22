"""Rows, series and values that must not get lost on the way."""

import datetime
import os
import subprocess
import sys
import zipfile

import numpy as np
from pyspark.sql import functions as F

from lumenframe import sources as S
from lumenframe.operators import arma, baskets, daily, frame, lsa, stationarity, text, var
from lumenframe.operators.features import dummies
from lumenframe.plans import QUERIES
from lumenframe.runtime import ship_package

from .conftest import SF

DAY = datetime.date(2020, 1, 1)


def series(spark, **values):
    rows = [(k, DAY + datetime.timedelta(days=i), float(v)) for k, vs in values.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "series_id string, t date, y double")


def mixed_lengths(spark):
    rng = np.random.default_rng(1)
    return series(spark, long=rng.standard_normal(60).cumsum(), short=[1, 2, 4, 3], flat=[5.0] * 40)


def test_short_and_constant_series_stay(spark):
    days = mixed_lengths(spark)
    fits = {r.series_id: r for r in arma.fit_arma(days, "y", [(2, 3)]).collect()}
    assert set(fits) == {"long", "short", "flat"}
    assert fits["long"].reason is None and fits["long"].aic is not None
    assert fits["short"].aic is None and "few" in fits["short"].reason and "constant" in fits["flat"].reason
    best = {(r.series_id, r.criterion): (r.p, r.q) for r in arma.select_order(days, "y", 1, 1).collect()}
    assert best["flat", "aic"] == (None, None) and None not in best["long", "bic"] and None not in best["short", "aic"]
    lags = var.select_order(days.withColumn("y2", F.col("y") * F.col("y") + F.dayofyear("t")), 3).collect()
    assert len(lags) == 3 * 4 and {r.reason is None for r in lags if r.series_id == "short"} == {False}


def test_undefined_statistics_decide_nothing(spark):
    days = mixed_lengths(spark)
    both = {r.series_id: r for r in stationarity.stationarity_decision(stationarity.adf_test(days, "y", 2), stationarity.kpss_test(days, "y")).collect()}
    assert both["flat"].kpss is None and both["flat"].adf is None and both["flat"].kpss_p is None
    assert both["long"].kpss is not None and both["long"].adf is not None


def test_calendar_keeps_null_series_and_values(spark):
    rows = [(None, DAY, 5.0), (None, DAY + datetime.timedelta(days=2), 7.0), ("a", DAY, None)]
    got = daily.fill_calendar(spark.createDataFrame(rows, "series_id string, t date, y double")).collect()
    assert sorted(((r.series_id or "", r.t.day, r.y) for r in got), key=str) == sorted([("", 1, 5.0), ("", 2, 0.0), ("", 3, 7.0), ("a", 1, None)], key=str)


def test_null_categories(spark):
    rows = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, c string")
    assert [r.k for r in frame.drop_sentinel(rows, "c", "x").orderBy("k").collect()] == [2, 3]
    hot = {r.k: (r.x, r.y) for r in frame.one_hot(rows, "c").collect()}
    assert hot == {1: (1, 0), 2: (0, 0), 3: (0, 1)}
    coded = rows.withColumns(dummies({"c": ["x", "y"]}))
    assert {r.k: r.c_y for r in coded.collect()} == {1: 0.0, 2: 0.0, 3: 1.0}


def test_many_levels(spark):
    rows = spark.range(20_000).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("c"), "id").unionByName(
        spark.createDataFrame([(None, -1)], "c string, id long")
    )
    coded = frame.with_factor_code(rows, "c", "code")
    assert coded.where("code = id + 1").count() == 20_000 and coded.where("code is null").count() == 1
    assert frame.one_hot_long(rows, ["id"], "c").count() == 20_000


def test_lines_are_numbered_in_files_of_any_size(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.txt").write_bytes(b"".join(f"w{i} é\r\n".encode("ISO-8859-1") if i % 9 else b"\n" for i in range(3000)))
    # Splits of a few hundred bytes: a file is many tasks.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = sorted(r.word for r in S.read_list_skipping(spark, str(tmp_path), [1, 2998]).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted(2 * [f"w{i}" for i in range(3000) if i % 9 and i not in (1, 2998)])


def test_last_year_tests_and_all_others_train(spark):
    r = QUERIES["random_forest_regressor"](spark, SF).first()
    assert r.n_train + r.n_test == spark.read.parquet(f"{SF}/lineitem.parquet").count() and r.n_test > 0


def test_words_of_letters_only(spark):
    rows = spark.createDataFrame([(1, "abc123def don't x-ray Straße, hund. hund (le) été"), (2, None), (3, "")], "doc_id int, text string")
    bag = text.bag_of_words(rows).collect()
    assert sorted((r.doc_id, r.term, r.tf, r.doc_terms) for r in bag) == [(1, "hund", 2, 4), (1, "straße", 1, 4), (1, "été", 1, 4)]
    assert "Exchange" not in text.bag_of_words(rows)._jdf.queryExecution().executedPlan().toString()


def test_index_without_stop_words(spark):
    docs = spark.createDataFrame([(1, "The cats and the dogs"), (2, "and the"), (3, None)], "doc_id long, text string")
    lemmas = spark.createDataFrame([("cats", "cat"), ("dogs", "dog")], "term string, lemma string")
    for table, want in ((None, ["cats", "dogs"]), (lemmas, ["cat", "dog"])):
        got = {r.doc_id: sorted(r.words) for r in lsa.word_table(docs, stop=["the", "and"], lemmas=table).collect()}
        assert got == {1: want, 2: [], 3: []}


def test_itemsets_are_mined_once(spark):
    sets = baskets.frequent_itemsets(spark.createDataFrame([(["a", "b"],)] * 9 + [(["c"],)], "items array<string>"))
    rules = baskets.association_rules(sets, 0.5)
    assert {(tuple(r.lhs), tuple(r.rhs)) for r in rules.collect()} == {(("a",), ("b",)), (("b",), ("a",))}
    assert "ExistingRDD" not in rules._jdf.queryExecution().executedPlan().toString()


def test_package_is_shipped(spark):
    ship_package(spark)
    zips = [f for f in spark.sparkContext.listFiles if f.endswith("lumenframe.zip")]
    assert len(zips) == 1
    names = zipfile.ZipFile(zips[0].removeprefix("file:")).namelist() if os.path.exists(zips[0].removeprefix("file:")) else ["lumenframe/runtime.py"]
    assert "lumenframe/runtime.py" in names


def test_python_workers_from_another_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {root!r}); import __spark_entry__ as e; from lumenframe.runtime import session; "
        f"print('rows', e.queries()['arma_fit'](session('elsewhere', 2), {SF!r}).count())"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]

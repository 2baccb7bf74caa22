"""Numeric checks of the solvers against direct computation."""

import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lumenframe import sources as S
from lumenframe.functions.vectors import rbf_kernel
from lumenframe.operators import arma, classify, kernel_ridge, lsa, neural, regress, tuning, var
from lumenframe.operators import daily as D
from lumenframe.operators import stationarity as T
from lumenframe.operators.features import with_fold
from lumenframe.runtime import fresh_path


def series(spark, **values):
    start = datetime.date(1959, 1, 1)
    rows = [
        (name, start + datetime.timedelta(days=i), *[float(c[i]) for c in cols])
        for name, cols in values.items()
        for i in range(len(cols[0]))
    ]
    names = ["y", "y2"][: len(next(iter(values.values())))]
    return spark.createDataFrame(rows, "series_id string, t date, " + ", ".join(f"{n} double" for n in names))


@pytest.fixture(scope="module")
def simulated():
    rng = np.random.default_rng(0)
    n = 3000
    e = rng.normal(0, 1, n)
    ar, ma = np.zeros(n), np.zeros(n)
    for i in range(1, n):
        ar[i] = 0.6 * ar[i - 1] + e[i]
        ma[i] = e[i] - 0.5 * e[i - 1]
    return {"ar": ar + 2, "ma": ma + 1, "walk": np.cumsum(e), "noise": rng.normal(0, 1, n)}


def test_arma_recovers_coefficients(spark, simulated):
    daily = series(spark, ar=[simulated["ar"]], ma=[simulated["ma"]])
    fits = {(r["series_id"], r["p"], r["q"]): r for r in arma.fit_arma(daily, "y", [(1, 0), (0, 1)]).collect()}
    assert fits[("ar", 1, 0)]["ar"][0] == pytest.approx(0.6, abs=0.05)
    assert fits[("ar", 1, 0)]["const"] == pytest.approx(2, abs=0.15)
    assert fits[("ma", 0, 1)]["ma"][0] == pytest.approx(-0.5, abs=0.05)
    assert fits[("ma", 0, 1)]["sigma2"] == pytest.approx(1, abs=0.1)
    chosen = {r["series_id"]: (r["p"], r["q"]) for r in arma.select_order(daily, "y", 2, 2).where("criterion = 'bic'").collect()}
    assert chosen["ar"] == (1, 0) and chosen["ma"] == (0, 1)


def test_arma_residuals_follow_the_recursion(simulated):
    y = simulated["ma"][:300]
    fit = arma.fit_one(y, 1, 2)
    d, e = y - fit.mean, np.zeros(len(y))
    for t in range(len(y)):
        e[t] = d[t]
        for i, a in enumerate(fit.ar, 1):
            e[t] -= a * d[t - i] if t >= i else 0
        for j, b in enumerate(fit.ma, 1):
            e[t] -= b * e[t - j] if t >= j else 0
    assert np.allclose(e, fit.residuals, atol=1e-8)
    assert np.abs(fit.jacobian.T @ fit.residuals).max() < 0.05


def test_unit_root_tests(spark, simulated):
    daily = series(spark, **{k: [v] for k, v in simulated.items()})
    adf = {r["series_id"]: r for r in T.adf_test(daily, "y", 5).collect()}
    assert adf["ar"]["p_value"] < 0.05 and adf["noise"]["p_value"] < 0.05
    assert adf["walk"]["p_value"] > 0.05
    assert adf["walk"]["crit_5pct"] == pytest.approx(-2.8625, abs=1e-3)
    kpss = {r["series_id"]: r for r in T.kpss_test(daily, "y").collect()}
    assert kpss["walk"]["p_value"] == 0.01 and kpss["noise"]["p_value"] > 0.05
    # The statistic of the chosen model by plain least squares.
    y, p = simulated["ar"], adf["ar"]["lags"]
    dy = np.diff(y)
    x = np.column_stack([np.ones(len(dy) - p), y[p:-1], *[dy[p - i : len(dy) - i] for i in range(1, p + 1)]])
    beta, sse, *_ = np.linalg.lstsq(x, dy[p:], rcond=None)
    se = np.sqrt(sse[0] / (len(x) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])
    assert adf["ar"]["statistic"] == pytest.approx(beta[1] / se, rel=1e-8)
    assert adf["ar"]["n"] == len(x)


def test_rolling_forecast_matches_single_fits(spark, simulated):
    y = simulated["ma"][:120]
    rows = arma.rolling_forecast(series(spark, ma=[y]), "y", 0, 1, block=7).orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(96, 120))
    for r in rows[::6]:
        alone = arma.fit_one(y[: r["position"]], 0, 1).next_value(y[: r["position"]])
        assert r["forecast"] == pytest.approx(alone, abs=1e-3)


def test_vector_autoregression(spark):
    rng = np.random.default_rng(3)
    z = np.zeros((400, 2))
    a = np.array([[0.5, 0.1], [-0.2, 0.3]])
    for i in range(1, 400):
        z[i] = a @ z[i - 1] + rng.normal(0, 1, 2) + [1, -1]
    daily = series(spark, s=[z[:, 0], z[:, 1]])
    model = {r["equation"]: r for r in var.fit_var(daily, 2).collect()}
    x = np.column_stack([np.ones(398), z[1:-1], z[:-2]])
    want, *_ = np.linalg.lstsq(x, z[2:], rcond=None)
    assert np.allclose([model["y"]["const"], *model["y"]["coef"]], want[:, 0], atol=1e-8)
    assert np.allclose([model["y2"]["const"], *model["y2"]["coef"]], want[:, 1], atol=1e-8)
    rolled = var.forecast_rolling(daily, 2, 0.2).orderBy("t").collect()
    assert len(rolled) == 80
    for k in (0, 40, 79):
        t = 320 + k
        x = np.column_stack([np.ones(t - 2), z[1 : t - 1], z[: t - 2]])
        beta, *_ = np.linalg.lstsq(x, z[2:t], rcond=None)
        hat = np.concatenate([[1.0], z[t - 1], z[t - 2]]) @ beta
        assert np.allclose([rolled[k]["y_hat"], rolled[k]["y2_hat"]], hat, atol=1e-7)
    fixed = var.forecast_fixed(daily, 1, 0.2).orderBy("t").collect()
    beta, *_ = np.linalg.lstsq(np.column_stack([np.ones(319), z[:319]]), z[1:320], rcond=None)
    assert np.allclose([fixed[5]["y_hat"], fixed[5]["y2_hat"]], np.concatenate([[1.0], z[324]]) @ beta, atol=1e-8)
    orders = {r["lags"]: r for r in var.select_order(daily, 4).collect()}
    assert min(orders, key=lambda p: orders[p]["bic"]) == 1


def test_kernel_ridge_equals_the_direct_solution(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (120, 3))
    y = np.sin(x[:, 0]) + x[:, 1] ** 2
    df = spark.createDataFrame([(i, x[i].tolist(), float(y[i])) for i in range(120)], "id int, x array<double>, y double")
    marks, weights = kernel_ridge.fit(df.repartition(4), "id", "x", "y", alpha=0.1, gamma=0.3, m=1000)
    gap = ((x[:, None] - x[None]) ** 2).sum(2)
    k = np.exp(-0.3 * gap)
    direct = k @ np.linalg.solve(k + 0.1 * np.eye(120), y)
    got = kernel_ridge.predict(df, "x", marks, weights, 0.3).orderBy("id").toPandas()["prediction"]
    assert np.allclose(got, direct, atol=1e-6)
    same = df.select("id", rbf_kernel(F.col("x"), F.array(*[F.lit(float(v)) for v in x[0]]), 0.3).alias("k"))
    assert np.allclose(same.orderBy("id").toPandas()["k"], k[0])

    folds = tuning.contiguous_folds(df, "id", 4)
    scores, best = kernel_ridge.grid_search(folds, "id", "x", "y", "fold", [0.1, 10.0], [0.3, 3.0], m=1000)
    rows = {(r["alpha"], r["gamma"], r["fold"]): r["rmse"] for r in scores.collect()}
    assert len(rows) == 16 and best["alpha"] == 0.1
    # Landmarks include the held-out rows, so the span is wider than the direct one.
    train = np.arange(120) >= 30
    w = np.linalg.solve(k[np.ix_(train, train)] + 0.1 * np.eye(90), y[train])
    direct_rmse = np.sqrt(np.mean((k[np.ix_(~train, train)] @ w - y[~train]) ** 2))
    assert rows[(0.1, 0.3, 0)] == pytest.approx(direct_rmse, abs=1e-4)


def test_lasso_equals_sparks(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (800, 5)) * [1, 2, 3, 4, 5]
    y = 3 * x[:, 0] - x[:, 2] + rng.normal(0, 1, 800)
    names = [f"x{i}" for i in range(5)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(y=y, id=np.arange(800)))
    found = regress.lasso_cv(with_fold(df, "id", 5), "y", names, "fold", n_lambdas=20)
    rows = regress.vectors(df, names, "y")
    same = LinearRegression(elasticNetParam=1.0, regParam=found["lambda"], tol=1e-10, maxIter=500, solver="l-bfgs").fit(rows)
    assert np.allclose(found["coef"], same.coefficients.toArray(), atol=5e-3)
    assert found["intercept"] == pytest.approx(same.intercept, abs=1e-2)


def test_neural_net_learns(spark):
    rng = np.random.default_rng(5)
    x = rng.random((1000, 2))
    y = (x[:, 0] - 0.5) ** 2 * 4
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": y})).repartition(4)
    net = neural.fit(df, ["a", "b"], "y", steps=60)
    error = neural.predict(df, net, ["a", "b"]).agg(F.avg(F.pow(F.col("y") - F.col("prediction"), F.lit(2.0)))).first()[0]
    assert error < 0.2 * y.var()


def test_latent_index(spark):
    rng = np.random.default_rng(6)
    words = [f"w{i:03d}" for i in range(150)]
    docs = [(d, [words[(7 * d + int(w)) % 150] for w in rng.integers(0, 20, 30)]) for d in range(60)]
    df = spark.createDataFrame(docs, "doc_id bigint, words array<string>")
    index = lsa.fit(df, n_terms=150, k=6)
    u = np.array([r["u"] for r in index.documents().orderBy("doc_id").collect()])
    assert np.allclose(u.T @ u, np.eye(6), atol=1e-6)
    ids = {r["term"]: r["term_id"] for r in index.terms.collect()}
    a = np.zeros((60, len(ids)))
    for r in index.weights.collect():
        a[r["doc_id"], r["term_id"]] = r["weight"]
    assert np.allclose(index.singular, np.linalg.svd(a)[1][:6], atol=1e-8)
    v = np.linalg.svd(a)[2][:6].T
    q = np.zeros(len(ids))
    idf = {r["term"]: r["idf"] for r in index.terms.collect()}
    for w in ("w003", "w004"):
        q[ids[w]] = idf[w]
    us, qv = a @ v, v.T @ q
    want = us @ qv / np.linalg.norm(us, axis=1) / np.linalg.norm(qv)
    got = {r["doc_id"]: r["score"] for r in lsa.search(index, ["w003", "w004", "nowhere"], None).collect()}
    assert np.allclose([got[i] for i in range(60)], want, atol=1e-6)


def test_grid_order():
    want = [(1, 4), (1, 5), (2, 4), (2, 5), (3, 4), (3, 5)]
    assert [(g["alpha"], g["gamma"]) for g in tuning.grid(gamma=[4, 5], alpha=[1, 2, 3])] == want


def weather_line(air, dew="+0012"):
    line = list("#" * 98)
    for at, text in ((15, "1950010203"), (28, "+59000"), (34, "-018000"), (46, "+0017"), (60, "160"), (65, "0046"),
                     (70, "00450"), (78, "020000"), (87, air), (93, dew)):
        line[at : at + len(text)] = text
    return "".join(line)


def test_weather_lines(spark):
    rows = spark.createDataFrame([(weather_line(a),) for a in ("+0100", "+9999", "-0123")], "l string")
    got = S.read_fixed_width(spark, S.write_lines(rows, F.col("l"), fresh_path(spark, "t"))).orderBy("airTemperature").collect()
    assert [r["airTemperature"] for r in got] == [-12.3, 10.0]
    r = got[0]
    assert (r["year"], r["month"], r["day"], r["hour"], r["latitude"], r["longitude"]) == (1950, 1, 2, 3, 59.0, -18.0)
    assert (r["elevationDimension"], r["speedRate"], r["dewPointTemperature"]) == (17, 4.6, 1.2)


# Tags and classes of one site's review pages.
REVIEWS = {
    "text_tag": "p", "text_class": "comment", "score_tag": "div", "score_class": "i-stars__09f24__M1AR7", "score_attribute": "aria-label",
}


def test_reviews(spark):
    star = '<div class="i-stars__09f24__M1AR7 x" aria-label="{} star rating"></div>'
    text = '<p class="comment__09f24 css">{}</p>'
    good = "<html>" + star.format(4) + "".join(text.format(f"<b>t{i}</b>!") + star.format(i) for i in (1, 5, 3)) + star.format(2)
    bad = text.format("no score") + "<p>plain</p>"
    pages = spark.createDataFrame([(1, good), (2, bad), (3, star.format("x") + text.format("a") + star.format("y"))], "page_id int, html string")
    got = [(r["page_id"], r["review"], r["real_score"]) for r in S.paired_review_rows(pages, **REVIEWS).orderBy("pos").collect()]
    assert got == [(1, "t1!", 1), (1, "t5!", 5), (1, "t3!", 3)]


def test_calendar_gaps(spark):
    rows = spark.createDataFrame([("a", "2024-01-01"), ("a", "2024-01-04"), ("a", "2024-01-04")], "s string, d string")
    daily = D.fill_calendar(D.daily_series(rows, F.col("s"), F.to_date("d", "yyyy-MM-dd"), y=F.count(F.lit(1)).cast("double")))
    assert [r["y"] for r in daily.orderBy("t").collect()] == [1.0, 0.0, 0.0, 2.0]


def test_only_the_fit_that_failed_runs_again():
    from pyspark.errors import NumberFormatException

    calls = []

    def fit():
        calls.append(1)
        if len(calls) == 1:
            raise NumberFormatException("Cannot parse null string")
        return "model"

    assert tuning._try(fit) == "model" and len(calls) == 2


def test_moments_of_many_groups(spark):
    from lumenframe.operators import ols

    rows = spark.range(600_000).selectExpr("id % 200000 as g", *[f"cast((id * {k}) % 101 as double) as x{k}" for k in (3, 5, 7, 11, 13)])
    found = ols.moments(rows, ["g"], ["x3", "x5", "x7", "x11", "x13"])
    row = found.agg(F.count(F.lit(1)), F.sum("n"), F.min("n"), F.max("n")).first()
    assert tuple(row) == (200_000, 600_000, 3, 3)


def test_two_class_model_scores_in_an_observed_session(spark):
    own, seen = spark.newSession(), Observation()
    own.range(4).observe(seen, F.max("id").alias("last")).collect()
    rows = own.range(60).select((F.col("id") % 7).alias("x"), F.when(F.col("id") % 7 > 3, "Yes").otherwise("No").alias("status"))
    model = classify.fitted(classify.hashed_pipeline(["x"], "status", classify.forest(trees=2, depth=2)), rows)
    assert model.transform(rows).where("prediction >= 0").count() == 60


def test_index_looks_up_bounded_numbers_of_words(spark, monkeypatch):
    words = spark.createDataFrame([(i, ["b", "a", "b", "z"] * (i % 3)) for i in range(9)], "doc_id bigint, words array<string>").coalesce(1)
    want = lsa.indexed(words, ["a", "b"], [1.0, 2.0]).orderBy("doc_id").collect()
    monkeypatch.setattr(lsa, "HELD_WORDS", 5)
    batch = lsa.pa.RecordBatch.from_pydict({"words": [r["words"] for r in words.orderBy("doc_id").collect()]})
    held = [sum(map(len, part.column(0).to_pylist())) for part in lsa._slices(batch, "words", 5)]
    assert sum(held) == 36 and max(held) == 8  # a row of eight words stands alone
    assert lsa.indexed(words, ["a", "b"], [1.0, 2.0]).orderBy("doc_id").collect() == want
    assert want[1]["ids"] == [0, 1] and want[1]["weights"] == [0.25, 1.0] and want[0]["ids"] == []

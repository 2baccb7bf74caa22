"""Conjugate gradients over all rows against the direct solution."""

import numpy as np
import pytest

from lumenframe.operators import kernel_ridge, kernel_solver


def table(spark, n, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.uniform(-1, 1, (n, 3))
    y = np.sin(3 * x[:, 0]) + x[:, 1] * x[:, 2]
    return x, y, spark.createDataFrame([(i, a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id long, x array<double>, y double")


@pytest.mark.parametrize("kind,gamma", [("rbf", 0.5), ("poly", 0.3)])
def test_equals_the_direct_solution(spark, monkeypatch, kind, gamma):
    monkeypatch.setattr(kernel_solver, "BLOCK_ROWS", 300)
    monkeypatch.setattr(kernel_solver, "VALUES", 5000)
    x, y, df = table(spark, 1000)
    solution, about = kernel_solver.solve(df, "id", "x", "y", 1e-3, gamma, kind, m=60, tolerance=1e-12)
    direct = np.linalg.solve(kernel_ridge.kernel(x, x, kind, gamma) + 1e-3 * np.eye(1000), y)
    got = {r.key: r.weight for r in kernel_solver.weights(solution).collect()}
    assert solution.count() == 4 and about["steps"] < 40 and about["error"] <= 1e-12
    assert np.array([got[i] for i in range(1000)]) == pytest.approx(direct, rel=1e-8, abs=1e-8 * np.abs(direct).max())
    other, _, test = table(spark, 50, seed=1)
    found = {r.id: r.prediction for r in kernel_solver.predict(test, "id", "x", solution, about).collect()}
    assert [found[i] for i in range(50)] == pytest.approx(kernel_ridge.kernel(other, x, kind, gamma) @ direct, rel=1e-6, abs=1e-8)


def test_every_row_a_landmark_and_odd_tables(spark):
    x, y, df = table(spark, 40)
    _, about = kernel_solver.solve(df, "id", "x", "y", 0.1, 0.5, m=40)
    assert about["steps"] <= 3
    empty, about = kernel_solver.solve(df.limit(0), "id", "x", "y", 0.1, 0.5)
    assert empty.count() == 0 and kernel_solver.weights(empty).count() == 0
    zero, about = kernel_solver.solve(df.selectExpr("id", "x", "0.0D as y"), "id", "x", "y", 0.1, 0.5)
    assert about["steps"] == 0 and {r.weight for r in kernel_solver.weights(zero).collect()} == {0.0}


def test_stops_where_it_must(spark, caplog):
    _, _, df = table(spark, 60)
    _, about = kernel_solver.solve(df, "id", "x", "y", 1e-6, 0.5, m=5, max_steps=1)
    assert about["steps"] == 1 and about["error"] > 1e-10 and "residual" in caplog.text

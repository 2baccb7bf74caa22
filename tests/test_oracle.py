"""Every query with a DuckDB twin gives the same rows; every other one gives rows."""

import importlib.util
import os

import duckdb
import pytest

from .conftest import SF

spec = importlib.util.spec_from_file_location(
    "check", os.path.join(os.path.dirname(__file__), "..", "tools", "check.py")
)
check = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check)

from lumenframe.plans import ORACLE, QUERIES  # noqa: E402

# Costly fits that other entries exercise with the same code.
HEAVY = {
    "bagged_trees", "best_params", "compare_trained_models", "random_search", "regression_tree_grid",
    "bagged_trees_cv", "bagged_trees_importance", "random_forest_oob", "regression_tree_pruned", "polynomial_regression",
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows_of(records, order):
    return sorted((tuple(check.plain(r[i]) for i in order) for r in records), key=check.key)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, con, name):
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLE[name])
    columns = sorted(df.columns)
    assert sorted(rel.columns) == columns
    got = rows_of(df.select(*[f"`{c}`" for c in columns]).collect(), range(len(columns)))
    want = rows_of(rel.fetchall(), [rel.columns.index(c) for c in columns])
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - HEAVY))
def test_gives_rows(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.limit(1).count() == 1


def test_entry_point():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())

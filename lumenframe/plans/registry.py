"""Registry filled by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, text: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query, with the DuckDB statement giving the same rows if there is one.

    ``text`` names date columns to hand out as text, so that both engines' results
    compare the same whatever client library reads them.
    """

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in text})

        QUERIES[name] = run
        if sql is not None:
            casts = ", ".join(f"cast({c} as varchar) as {c}" for c in text)
            ORACLE[name] = f"select * replace ({casts}) from ({sql.strip()})" if text else sql.strip()
        return fn

    return add

"""Runnable queries over the driver tables, each next to its DuckDB twin."""

from .registry import ORACLE, QUERIES  # noqa: F401
from . import (  # noqa: F401
    baskets_clusters,
    evaluation,
    features,
    frames,
    joins,
    models,
    ordering,
    profiling,
    scalars,
    series,
    sources,
    text,
    tuning,
    windows,
)

"""Every registered query, with its SQL counterpart where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetrics.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` must yield the same columns and rows."""
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return as_text_dates(fn(configure(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def as_text_dates(df: DataFrame) -> DataFrame:
    """Timestamps and dates as text, so both engines show them alike."""
    shown = {}
    for name, kind in df.dtypes:
        if kind.startswith("timestamp"):
            shown[name] = F.date_format(name, "yyyy-MM-dd HH:mm:ss")
        elif kind == "date":
            shown[name] = F.date_format(name, "yyyy-MM-dd")
    return df.withColumns(shown) if shown else df


def load() -> None:
    from checks import (queries_analytics, queries_clean, queries_features,  # noqa: F401
                        queries_feeds, queries_quality, queries_sources)

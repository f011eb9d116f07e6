"""Registry of named queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline import session

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL it is checked by its row count and by the tests."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(session.adopt(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def r6(col: Column | str) -> Column:
    """Rounded to six places: float sums differ in the last bits between engines."""
    return F.round(F.col(col) if isinstance(col, str) else col, 6)


def load() -> None:
    """Import the query modules, which register themselves."""
    from stayline.plans import (  # noqa: F401
        columns, continuity, draws, features, learning, relations, scans, streams,
    )

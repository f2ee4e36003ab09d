"""Registration of queries together with their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.catalog.views import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return query

    return add


def r6(column: Column | str) -> Column:
    """Rounded to six places, for comparison between engines."""
    return F.round(F.col(column) if isinstance(column, str) else column, 6)

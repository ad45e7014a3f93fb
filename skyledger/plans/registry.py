"""Where queries on the stand-in views, and their SQL, are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .standins import duck, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None, *views: str) -> Callable:
    """Registers a function of the named views."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(*[view(spark, sf_dir, v) for v in views])
        if sql is not None:
            # a tail that begins with a comma adds to the views
            ORACLE_SQL[name] = sql if sql.startswith("WITH") else f"{duck(*views)} {sql}"
        return f

    return add


def r(c: Column | str, name: str, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits).alias(name)

"""The registered queries and the SQL each one is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from teletide.plans.views import with_views
from teletide.sources import warehouse

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is written against the derived views."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn
    return add


def on(view: str, fn: Callable[[DataFrame], DataFrame]) -> Query:
    """A query over one derived table."""
    return lambda spark, root: fn(warehouse.BUILDERS[view](spark, root))


def bigints(df: DataFrame) -> DataFrame:
    """Integer columns widened, so that both engines report one integer type."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("bigint").alias(f.name) if f.dataType.simpleString() == "int"
        else F.col(f"`{f.name}`") for f in df.schema.fields])


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """Number the rows of a limited result (a page or top-k) in their order."""
    return df.withColumn("rn", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def joined(column: str) -> Column:
    """An array as comma-separated text."""
    return F.array_join(F.col(column).cast("array<string>"), ",").alias(column)

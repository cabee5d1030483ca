"""What is there: attribute names and values, metrics, series and exemplars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from teletide.functions.attrs import attr, canonical_json
from teletide.model import METRIC_TABLES, metric_kind


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def attr_names(tables: dict[str, DataFrame]) -> DataFrame:
    """Distinct attribute keys over all tables, and ``service.name`` if any row has a service."""
    own = F.when(F.col("service").isNotNull(), F.array(F.lit("service.name"))).otherwise(
        F.array().cast("array<string>"))
    keys = F.concat(F.coalesce(F.json_object_keys("attributes"), F.array().cast("array<string>")), own)
    # Distinct per table first: the shuffle then carries a handful of names per task.
    names = [t.select(F.explode(keys).alias("name")).distinct() for t in tables.values()]
    return _union(names).distinct().orderBy("name")


def attr_values(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Distinct values of one attribute over all tables."""
    values = [t.select(attr(t, key).alias("value")).where(F.col("value").isNotNull()).distinct()
              for t in tables.values()]
    return _union(values).distinct().orderBy("value")


def metric_catalog(tables: dict[str, DataFrame]) -> DataFrame:
    """Distinct metric, unit and temporality with the kind of table that holds them."""
    entries = [
        t.select("metric", "unit", "temporality", F.lit(metric_kind(name)).alias("kind")).distinct()
        for name, t in tables.items() if name in METRIC_TABLES
    ]
    return _union(entries)


def metric_series(points: DataFrame, metric: str) -> DataFrame:
    """Distinct label sets of a metric as canonical JSON; the service is not part of them."""
    raw = points.where(F.col("metric") == metric).select("attributes").distinct()
    return raw.select(canonical_json(F.col("attributes")).alias("labels")).distinct()


def metric_exemplars(points: DataFrame, metric: str | None = None) -> DataFrame:
    """Exemplars of one metric (or all): ``metric``, ``time``, ``value``, ids and attributes."""
    rows = points if metric is None else points.where(F.col("metric") == metric)
    return rows.select("metric", F.inline("exemplars"))



"""Resolving attribute keys to columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from teletide.model import RESERVED

SERVICE_KEYS = ("service", "service.name")


def columns(names: Iterable[str]) -> list[Column]:
    """Columns by name, quoted because promoted keys may hold dots."""
    return [F.col(f"`{n}`") for n in names]


def json_text(json: Column, key: str) -> Column:
    """Text of one top-level key of a JSON object; NULL when absent or JSON null."""
    if "'" in key:  # cannot be written inside a bracket-quoted JSON path
        return F.element_at(F.from_json(json, "map<string,string>"), F.lit(key))
    return F.get_json_object(json, f"$['{key}']")


def promoted_keys(df: DataFrame) -> set[str]:
    """Attribute keys that ``df`` carries as columns of their own."""
    return {c for c in df.columns if c not in RESERVED}


def attr(df: DataFrame, key: str) -> Column:
    """Value of attribute ``key``.

    The service goes by either spelling, a promoted key reads its column (and so can be pushed down
    to the Parquet scan), anything else is taken out of the ``attributes`` JSON.
    """
    if key in SERVICE_KEYS:
        return F.col("service")
    if key in promoted_keys(df):
        return columns([key])[0]
    return json_text(F.col("attributes"), key)


def group_columns(df: DataFrame, keys: list[str]) -> list[Column]:
    """One column ``g0..gN`` per group key, a missing label reading as the empty string."""
    return [F.coalesce(attr(df, k), F.lit("")).alias(f"g{i}") for i, k in enumerate(keys)]


def labels_json(keys: list[str]) -> Column:
    """Canonical JSON of the label set held in ``g0..gN``, labels spelled as in ``keys``."""
    if not keys:
        return F.lit("{}")
    ordered = sorted(range(len(keys)), key=lambda i: keys[i])
    return F.to_json(F.struct(*[F.col(f"g{i}").alias(keys[i]) for i in ordered]))


def canonical_json(json: Column) -> Column:
    """The JSON object with keys sorted at every level; NULL when the text is not JSON."""
    return F.to_json(F.try_parse_json(json))


def series_key(service: Column, metric: Column, attributes: Column) -> Column:
    """Identity of a time series: service, ``__name__`` and the string-valued attributes, as
    canonical JSON. Dots in the metric name read as underscores."""
    values = F.from_json(attributes, "map<string,variant>")
    strings = F.map_filter(values, lambda _, v: F.schema_of_variant(v) == "STRING")
    labels = F.transform_values(strings, lambda _, v: v.cast("string"))
    own = F.map_filter(
        F.create_map(F.lit("__name__"), F.replace(metric, F.lit("."), F.lit("_")),
                     F.lit("service"), service),
        lambda _, v: v.isNotNull(),
    )
    rest = F.map_filter(labels, lambda k, _: ~k.isin("__name__", "service"))
    entries = F.concat(F.map_entries(own), F.coalesce(F.map_entries(rest), F.array()))
    return F.to_json(F.map_from_entries(F.array_sort(entries)))

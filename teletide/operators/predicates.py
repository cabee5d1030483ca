"""Predicates shared by log queries and trace search, all AND-combined."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from teletide.functions import text
from teletide.functions.attrs import attr


@dataclass(frozen=True)
class AttrFilter:
    """Conditions on attributes, each keyed by attribute name."""

    attr_eq: dict[str, str] = field(default_factory=dict)
    attr_exists: list[str] = field(default_factory=list)
    attr_matches: dict[str, str] = field(default_factory=dict)
    attr_in: dict[str, list[str]] = field(default_factory=dict)
    attr_not_in: dict[str, list[str]] = field(default_factory=dict)
    attr_gt: dict[str, float] = field(default_factory=dict)
    attr_ge: dict[str, float] = field(default_factory=dict)
    attr_lt: dict[str, float] = field(default_factory=dict)
    attr_le: dict[str, float] = field(default_factory=dict)
    attr_regex: dict[str, str] = field(default_factory=dict)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def attr_conditions(df: DataFrame, q: AttrFilter) -> list[Column]:
    """A missing key or a value that is not a number fails every condition on it."""

    def number(key: str) -> Column:
        return attr(df, key).try_cast("double")

    return [
        *[attr(df, k) == v for k, v in q.attr_eq.items()],
        *[attr(df, k).isNotNull() for k in q.attr_exists],
        *[text.matches(attr(df, k), v) & attr(df, k).isNotNull() for k, v in q.attr_matches.items()],
        *[attr(df, k).isin(list(v)) for k, v in q.attr_in.items()],
        *[~attr(df, k).isin(list(v)) for k, v in q.attr_not_in.items()],
        *[number(k) > float(n) for k, n in q.attr_gt.items()],
        *[number(k) >= float(n) for k, n in q.attr_ge.items()],
        *[number(k) < float(n) for k, n in q.attr_lt.items()],
        *[number(k) <= float(n) for k, n in q.attr_le.items()],
        *[text.regex(attr(df, k), p) for k, p in q.attr_regex.items()],
    ]


def hex_id(value: str, digits: int) -> str:
    """Check and normalise a hex id."""
    lowered = value.lower()
    if len(lowered) != digits or any(c not in "0123456789abcdef" for c in lowered):
        raise ValueError(f"invalid id {value!r} (want {digits} hex digits)")
    return lowered


def equal_if_set(**columns: str) -> list[Column]:
    """Equality on each named column whose wanted value is not empty."""
    return [F.col(name) == value for name, value in columns.items() if value]

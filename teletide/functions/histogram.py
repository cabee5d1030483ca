"""Quantiles of explicit-bound histograms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def histogram_quantile(q: Column | float, bounds: Column, counts: Column) -> Column:
    """Quantile by linear interpolation inside the bucket that holds the rank.

    ``counts``, whole or fractional, has one entry more than ``bounds``, the last one being the overflow bucket. The lower
    edge of the first bucket is 0 when its bound is positive, else the bound itself. A rank in the
    overflow bucket gives the last bound, an empty histogram NULL.
    """
    q = q if isinstance(q, Column) else F.lit(float(q))
    counts = counts.cast("array<double>")
    total = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c)
    rank = q * total
    # Running totals, then the 1-based position of the first bucket that reaches the rank.
    running = F.aggregate(
        counts,
        F.array().cast("array<double>"),
        lambda acc, c: F.concat(acc, F.array(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0.0)) + c)),
    )
    position = F.size(F.filter(running, lambda r: r < rank)) + 1
    # The rank of q = 0 falls on an empty leading bucket; move on to the first one with rows.
    first_filled = F.size(F.filter(running, lambda r: r == 0)) + 1
    position = F.greatest(position, first_filled)
    index = position - 1
    upper = F.get(bounds, index)
    lower = F.when(index > 0, F.get(bounds, index - 1)).when(
        upper > 0, F.lit(0.0)).otherwise(upper)
    in_bucket = F.get(counts, index)
    below = F.get(running, index) - in_bucket
    inside = lower + (upper - lower) * (rank - below) / in_bucket
    return (
        F.when((total <= 0) | (F.size(bounds) == 0), F.lit(None).cast("double"))
        .when(position > F.size(bounds), F.get(bounds, F.size(bounds) - 1))
        .otherwise(inside)
    )

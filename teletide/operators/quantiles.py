"""Exact quantiles per group that never bring a whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from teletide.functions import times
from teletide.session import materialize_small

# Logarithmic bins per doubling of the value, then the width of a fine bin.
_BINS_PER_OCTAVE = 256
_FINE_WIDTH = 1 << 16


def _coarse_bin(value: Column) -> Column:
    """Grows with the value; negative values (clock skew) get the mirrored bins below zero."""
    size = F.floor(F.log2(F.abs(value).cast("double") + 1) * _BINS_PER_OCTAVE)
    return F.when(value >= 0, size).otherwise(-size - 1)


def _ranks(q: float, total: Column) -> tuple[Column, Column]:
    """Zero-based ranks of the two values the quantile lies between."""
    at = (total - 1) * F.lit(float(q))
    return F.floor(at), F.ceil(at)


# Rows a group may have for its values to be gathered in one buffer.
SPLIT_ABOVE = 20_000


def group_quantiles(
    df: DataFrame,
    group: list[str],
    value: str,
    quantiles: dict[str, float],
    extra: dict[str, Column] | None = None,
    split_above: int = SPLIT_ABOVE,
) -> DataFrame:
    """Exact quantiles per group: built-in ``percentile`` for the groups known to be small,
    ``exact_quantiles`` for the rest. Arguments and result are those of ``exact_quantiles``."""
    sizes = df.groupBy(*group).agg(F.count("*").alias("_n")).where(F.col("_n") > split_above)
    large, fits = materialize_small(sizes.select(*group), "large-groups")
    columns = [*group, "count", *(extra or {}), *quantiles]
    if large.isEmpty():
        return _gathered(df, group, value, quantiles, extra or {}).select(*columns)
    large = F.broadcast(large) if fits else large
    small = _gathered(df.join(large, group, "left_anti"), group, value, quantiles, extra or {})
    split = exact_quantiles(df.join(large, group, "left_semi"), group, value, quantiles, extra)
    return small.select(*columns).unionByName(split.select(*columns))


def _gathered(df: DataFrame, group: list[str], value: str, quantiles: dict[str, float],
              extra: dict[str, Column]) -> DataFrame:
    qs = F.percentile(value, list(quantiles.values()))
    return df.groupBy(*group).agg(
        F.count("*").alias("count"), *[c.alias(n) for n, c in extra.items()], qs.alias("_qs")).select(
        "*", *[F.get("_qs", i).alias(n) for i, n in enumerate(quantiles)])


def exact_quantiles(
    df: DataFrame,
    group: list[str],
    value: str,
    quantiles: dict[str, float],
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Interpolated quantiles of an integer column, one output row per group.

    ``quantiles`` names the output columns; ``extra`` holds further aggregates that can be added up
    (they are computed per bin and summed). Built-in ``percentile`` gathers every distinct value of a
    group in one buffer. Here the rows are first only counted per logarithmic bin, which gives the
    bins that hold a wanted rank (this pass runs at once, to learn how many they are); the second pass
    looks at the rows of these bins alone, in fine bins of fixed width and finally value by value. Each
    window therefore sees at most the bins of a group, the fine bins of a bin, or the values of a fine
    bin. A group without any value has its counts and NULL quantiles. Group columns must not be NULL.
    """
    extra = {"count": F.count("*"), **(extra or {})}
    binned = df.withColumn("_bin", _coarse_bin(F.col(value)))
    coarse = binned.groupBy(*group, "_bin").agg(
        F.count(value).alias("_n"), *[c.alias(n) for n, c in extra.items()])
    per_group = Window.partitionBy(*group)
    coarse = coarse.withColumns({
        "_base": F.coalesce(F.sum("_n").over(per_group.orderBy("_bin").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)),
        "_total": F.sum("_n").over(per_group),
        **{n: F.sum(n).over(per_group) for n in extra},
    })
    ranks = F.array(*[r.cast("bigint") for q in quantiles.values()
                      for r in _ranks(q, F.col("_total"))])
    coarse = coarse.withColumn("_ranks", F.filter(
        F.array_distinct(ranks), lambda r: (r >= F.col("_base")) & (r < F.col("_base") + F.col("_n"))))
    # A group without values is one bin, the NULL one; it is kept for its counts.
    wanted = coarse.where((F.size("_ranks") > 0) | (F.col("_total") == 0)).select(*group, "_bin", "_base", "_total", *extra)
    # A few bins per group. When they fit, the second pass filters in the scan's own tasks.
    stored, fits = materialize_small(wanted, "quantile-bins")
    wanted = F.broadcast(stored) if fits else stored

    # Second pass: only rows of the wanted bins, counted per value.
    values = binned.select(*group, "_bin", F.col(value).alias("_v")).join(
        wanted, [*group, "_bin"]).groupBy(
        *group, "_bin", "_base", "_total", *extra, "_v").agg(F.count("*").alias("_n"))
    values = values.withColumn("_fine", times.floor_div(F.col("_v"), _FINE_WIDTH))
    fine = values.groupBy(*group, "_bin", "_fine", "_base").agg(F.sum("_n").alias("_n"))
    in_bin = Window.partitionBy(*group, "_bin").orderBy("_fine").rowsBetween(
        Window.unboundedPreceding, -1)
    fine = fine.select(*group, "_bin", "_fine", (F.col("_base") + F.coalesce(
        F.sum("_n").over(in_bin), F.lit(0))).alias("_fine_base"))
    in_fine = Window.partitionBy(*group, "_bin", "_fine").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = values.withColumn("_before", F.coalesce(F.sum("_n").over(in_fine), F.lit(0))).join(
        fine, [*group, "_bin", "_fine"])
    first = F.col("_fine_base") + F.col("_before")
    placed = placed.withColumn("_first", first).withColumn("_last", first + F.col("_n") - 1)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_first") <= rank) & (F.col("_last") >= rank), F.col("_v")))

    total = F.col("_total")
    picks = [p for i, q in enumerate(quantiles.values()) for p in (
        at(_ranks(q, total)[0]).alias(f"_lo{i}"), at(_ranks(q, total)[1]).alias(f"_hi{i}"))]
    picked = placed.groupBy(*group, "_total", *extra).agg(*picks)

    def interpolated(i: int, q: float) -> Column:
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        at_rank = (F.col("_total") - 1) * F.lit(float(q))
        return low.cast("double") + (high - low) * (at_rank - F.floor(at_rank))

    found = picked.select(
        *group, *extra,
        *[interpolated(i, q).alias(name) for i, (name, q) in enumerate(quantiles.items())])
    without = stored.where(F.col("_total") == 0).select(
        *group, *extra, *[F.lit(None).cast("double").alias(name) for name in quantiles])
    return found.unionByName(without)

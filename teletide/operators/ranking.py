"""Row positions in a total order, without ever sorting one whole group in a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from teletide.functions.attrs import columns
from teletide.session import materialize, materialize_small

# Rows of one cell that may be sorted together.
HOT_CELL = 1_000_000


def with_position(
    df: DataFrame,
    order: list[Column],
    digits: list[Column],
    group: list[str] | tuple[str, ...] = (),
    name: str = "rn",
    fine: list[Column] | None = None,
    nulls_last: bool = False,
) -> DataFrame:
    """Add the 1-based position of each row within its group under ``order``.

    ``digits`` are coarse-to-fine keys that never decrease along ``order``, such as the minute and
    then the hundredth of a second. Rows are counted per finest cell (a partial aggregation), the
    counts are summed up level by level, and only the rows of one cell are sorted together. So a hot
    group is spread over its cells.

    ``fine`` continues the digits, down to parts of the tie-break, for cells that turn out to hold more
    than ``HOT_CELL`` rows, such as one instant shared by a large share of all rows; the counts are
    then taken at once, one digit after another for as long as a cell is hot. With a group and no digits the cells are the groups themselves, and as long as
    none is hot a plain window does. Without a group the coarsest digit is summed up in one task, so it
    must take few values (the minutes of a retention period). NULL digits
    come first as in an ascending order, or last with ``nulls_last``; group columns must not be NULL.
    """
    digits = [c for d in digits for c in _null_safe(d, nulls_last)]
    keys = [*group, *[f"_d{i}" for i in range(len(digits))]]
    rows = df.withColumns(dict(zip(keys[len(group):], digits)))
    cells = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    if fine:
        if digits:
            cells = materialize(cells, "cells")
        for i, digit in enumerate(fine):
            hot, fits = materialize_small(cells.where(F.col("_n") > HOT_CELL).select(*keys), "hot-cells")
            if hot.isEmpty():
                break
            hot = hot.withColumn("_hot", F.lit(True))
            rows = rows.join(F.broadcast(hot) if fits else hot, keys, "left")
            finer = [f"_f{i}", f"_g{i}"]
            rows = rows.withColumns({f: F.when(F.col("_hot"), d).otherwise(0) for f, d in zip(
                finer, _null_safe(digit, nulls_last))}).drop("_hot")
            keys = [*keys, *finer]
            cells = rows.groupBy(*keys).agg(F.count("*").alias("_n"))

    ranked = rows.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    if keys == list(group):
        return ranked.select(*columns(df.columns), F.col("_rank").cast("bigint").alias(name))
    offsets = _offsets(cells, keys, len(group))
    placed = ranked.join(offsets, keys).withColumn(name, F.col("_rank") + F.col("_offset"))
    return placed.select(*columns(df.columns), name)


def _null_safe(digit: Column, nulls_last: bool) -> list[Column]:
    """A digit that may be NULL as two that are not: the side its NULLs are on, and its value."""
    side = digit.isNull() if nulls_last else digit.isNotNull()
    return [side.cast("bigint"), F.coalesce(digit.cast("bigint"), F.lit(0))]


def _offsets(cells: DataFrame, keys: list[str], groups: int) -> DataFrame:
    """Rows of the group that lie before each cell: those before it inside its parent cell, plus the
    parent's own offset."""
    offsets = None
    for depth in range(groups, len(keys)):
        parent, here = keys[:depth], keys[: depth + 1]
        counts = cells if here == keys else cells.groupBy(*here).agg(F.sum("_n").alias("_n"))
        before = Window.partitionBy(*parent).orderBy(keys[depth]).rowsBetween(
            Window.unboundedPreceding, -1)
        inside = counts.select(*here, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
        if offsets is not None:
            inside = inside.join(offsets.withColumnRenamed("_offset", "_above"), parent).select(
                *here, (F.col("_offset") + F.col("_above")).alias("_offset"))
        offsets = inside
    return offsets

"""Points that share a series and an instant, and the policies for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from teletide.functions import times
from teletide.functions.attrs import columns, series_key

ERROR_ON_READ = "error_on_read"
LAST_WINS = "last_wins"
REJECT = "reject"

SERIES = ["metric", "service", "attributes"]


def survivor(value: str = "value") -> Column:
    """The largest value, NaN counting as the smallest."""
    v = F.col(value)
    return F.coalesce(F.max(F.when(~F.isnan(v), v)), F.max(v))


def last_wins(points: DataFrame, keys: list[str] | None = None, time: str = "point_time") -> DataFrame:
    """One value per (series, instant). A plain aggregate, so repeats vanish before the shuffle."""
    return points.groupBy(*columns(keys or SERIES), time).agg(survivor().alias("value"))


def last_wins_by_series(points: DataFrame, also: list[str] | None = None) -> DataFrame:
    """One point per (series, instant), the series being that of ``with_series``: metric, service, attributes, the
    columns ``also``, point_time and value of the survivor.

    Points that agree in all attributes are collapsed first, so that a key is made for each of those left only.
    """
    also = also or []
    left = with_series(last_wins(points, [*SERIES, *also]))
    v = F.col("value")
    rank = F.struct(F.coalesce(~F.isnan(v), F.lit(False)), v, "attributes")
    best = left.groupBy("_series", "metric", "service", "point_time").agg(
        F.max_by(F.struct("attributes", *columns(also), "value"), rank).alias("best"))
    return best.select("metric", "service", "best.attributes", *[F.col("best")[c].alias(c) for c in also], "point_time", "best.value")


def resolve(points: DataFrame, policy: str, keys: list[str] | None = None,
            time: str = "point_time") -> DataFrame:
    """Points with one value per (series, instant), or a failing read that names the repeated one."""
    keys = keys or SERIES
    if policy == LAST_WINS:
        return last_wins(points, keys, time)
    if policy != ERROR_ON_READ:
        raise ValueError(f"unknown duplicate policy {policy!r}")
    where = F.concat_ws(" ", *[c.cast("string") for c in columns(keys)])
    message = F.concat(F.lit("duplicate points for "), where, F.lit(" at "), F.col(time).cast("string"))
    return points.groupBy(*columns(keys), time).agg(F.max("value").alias("v"), F.count("*").alias("n")).select(
        *columns(keys), time, F.when(F.col("n") > 1, F.raise_error(message).cast("double")).otherwise(
            F.col("v")).alias("value"))


def duplicate_points(points: DataFrame, keys: list[str] | None = None,
                     time: str = "point_time") -> DataFrame:
    """The repeated (series, instant) pairs with their number of points.

    Without ``keys`` the series is that of ``with_series``, as for the step-grid reads and at ingest; of the
    attributes of one, the first in order are given.
    """
    if keys:
        return points.groupBy(*columns(keys), time).agg(F.count("*").alias("copies")).where("copies > 1")
    raw = points.groupBy(*columns(SERIES), time).agg(F.count("*").alias("copies"))
    return with_series(raw).groupBy("_series", "metric", "service", time).agg(
        F.min("attributes").alias("attributes"), F.sum("copies").alias("copies")).where("copies > 1").select(
        *columns(SERIES), time, "copies")


def with_series(points: DataFrame) -> DataFrame:
    """Points with ``_series``, the identity under which ingest compares them: service, name and the
    string attributes. Points that differ in a number only are repeats."""
    return points.withColumn("_series", series_key(F.col("service"), F.col("metric"), F.col("attributes")))


def reject_duplicates(points: DataFrame, arrival: list[str], existing: DataFrame | None = None,
                      keys: list[str] | None = None, time: str = "point_time") -> DataFrame:
    """The first point to arrive of each (series, instant) not stored yet, with ``copies``, the
    number of points offered for it, and ``stored``, whether it was there before.

    Without ``keys`` the series is that of ``with_series``. Of the stored points only those between
    the first and the last instant of the batch are read, and those without one if the batch has such.
    """
    if keys is None:
        known = None if existing is None else with_series(existing)
        found = reject_duplicates(with_series(points), arrival, known, ["_series"], time)
        return found.select(*columns(points.columns), "copies", "stored")
    by = [*columns(keys), F.col(time)]
    rest = [c for c in points.columns if c not in keys and c != time and c not in arrival]
    first = points.groupBy(*by).agg(
        F.min_by(F.struct(*arrival, *columns(rest)), F.struct(*arrival)).alias("first"),
        F.count("*").alias("copies"))
    offered = first.select(*by, *[F.col("first")[c].alias(c) for c in [*arrival, *rest]], "copies")
    if existing is None:
        return offered.withColumn("stored", F.lit(False))
    low, high, undated = points.agg(F.min(time), F.max(time), F.count_if(F.col(time).isNull())).first()

    def within(column: str, low: Column, high: Column) -> Column:
        dated = F.col(column).between(low, high)
        return dated | F.col(column).isNull() if undated else dated
    known = existing.where(within(time, F.lit(low), F.lit(high)))
    if "day" in existing.columns:  # prunes the partitions of a stored table
        known = known.where(within("day", times.to_day(F.lit(low).cast("long")), times.to_day(F.lit(high).cast("long"))))
    names = [f"_k{i}" for i in range(len(by))]
    renamed = known.groupBy(*[c.alias(n) for c, n in zip(by, names, strict=True)]).agg(F.lit(True).alias("stored"))
    # Series columns may be NULL (no service), so compare them NULL-safely.
    same = [c.eqNullSafe(F.col(n)) for c, n in zip(by, names, strict=True)]
    return offered.join(renamed, same, "left").drop(*names).withColumn("stored", F.coalesce("stored", F.lit(False)))


def accepted(rejected: DataFrame) -> DataFrame:
    """The rows to store out of ``reject_duplicates``."""
    return rejected.where(~F.col("stored")).drop("copies", "stored")


def receipt(rejected: DataFrame) -> DataFrame:
    """How many points were accepted and how many turned away."""
    taken = F.count_if(~F.col("stored"))
    return rejected.agg(
        taken.alias("accepted"), (F.coalesce(F.sum("copies"), F.lit(0)) - taken).alias("rejected"))

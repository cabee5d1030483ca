"""Metric points, ranges and instant values."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from teletide.functions import times
from teletide.functions.attrs import attr, canonical_json, columns, group_columns, labels_json, promoted_keys
from teletide.model import NS_PER_HOUR, POINT_COLUMNS
from teletide.operators import duplicates, predicates

VALUE_COLUMNS = {
    "gauge": ["value"],
    "sum": ["value"],
    "histogram": ["explicit_bounds", "bucket_counts"],
}


@dataclass(frozen=True)
class MetricQuery:
    """A gauge or sum over [start, end), resampled to ``step`` and split by ``group_by``."""

    metric: str
    step: int
    sum: bool = False
    start: int = 0
    end: int = 0
    group_by: list[str] = field(default_factory=list)
    duplicates: str = duplicates.ERROR_ON_READ


@dataclass(frozen=True)
class PointsQuery:
    metric: str
    kind: str = "gauge"
    filters: dict[str, str] = field(default_factory=dict)
    start: int = 0
    end: int = 0
    limit: int = 0


def metric_points(points: DataFrame, q: PointsQuery) -> DataFrame:
    """Raw samples of one metric."""
    if q.kind not in VALUE_COLUMNS:
        raise ValueError(f"unknown metric kind {q.kind!r}")
    rows = times.in_range(points, "point_time", q.start, q.end).where(F.col("metric") == q.metric)
    rows = rows.where(predicates.all_of([attr(points, k) == v for k, v in q.filters.items()]))
    rows = rows.select(*POINT_COLUMNS, *VALUE_COLUMNS[q.kind])
    rest = [c for c in rows.columns if c != "point_time"]
    return rows.orderBy("point_time", *rest).limit(q.limit) if q.limit > 0 else rows


def metric_range(points: DataFrame, q: MetricQuery) -> DataFrame:
    """Mean (gauge) or sum per step and label set: ``bucket``, ``g0..gN``, ``v``.

    Under ``last_wins`` repeated points of a series (metric, service and string attributes) are collapsed first; under ``error_on_read``, which guards
    only the step-grid reads, both count.
    """
    rows = times.in_range(points, "point_time", q.start, q.end).where(F.col("metric") == q.metric)
    if q.duplicates == duplicates.LAST_WINS:
        promoted = [k for k in q.group_by if k in promoted_keys(rows)]
        rows = duplicates.last_wins_by_series(rows, promoted)
    elif q.duplicates != duplicates.ERROR_ON_READ:
        raise ValueError(f"unknown duplicate policy {q.duplicates!r}")
    combine = F.sum if q.sum else F.avg
    groups = [f"g{i}" for i in range(len(q.group_by))]
    return rows.groupBy(times.bucket(F.col("point_time"), q.step).alias("bucket"),
                        *group_columns(rows, q.group_by)).agg(
        combine("value").alias("v")).select("bucket", *groups, "v")


def metric_instant(points: DataFrame, q: MetricQuery) -> DataFrame:
    """The last bucket of every series of the range: ``labels``, ``timestamp``, ``value``."""
    groups = [f"g{i}" for i in range(len(q.group_by))]
    last = metric_range(points, q).groupBy(*groups).agg(
        F.max("bucket").alias("timestamp"), F.max_by("v", "bucket").alias("value"))
    if not groups:  # an aggregate without keys answers even for no rows
        last = last.where(F.col("timestamp").isNotNull())
    return last.select(labels_json(q.group_by).alias("labels"), "timestamp", "value")


def _restarted(now: Column, before: Column) -> Column:
    """Whether a cumulative histogram began anew: its counts fell in some bucket."""
    return F.exists(F.zip_with(now, before, lambda a, b: a < b), lambda x: x)


def _grown(now: Column, before: Column) -> Column:
    """What each bucket gained since the point before; all of it after a restart, NULL without such a point."""
    gain = F.zip_with(now, before, lambda a, b: a - b)
    return F.when(before.isNotNull(), F.when(_restarted(now, before), now).otherwise(gain))


def histogram_increase(points: DataFrame) -> DataFrame:
    """Histogram points whose ``bucket_counts`` say what was observed since the point before.

    Delta points stay as they are. The counts of a cumulative series (metric, service, attributes and bounds) become
    the gain of every bucket since the last point; a restart, seen by a falling count, counts from zero, and the
    first point of a series, whose start is not known, only serves the next. Points of one instant are taken with the
    larger count last. Points of neither temporality, or with other than one count more than bounds, fail the read.
    A series is compared within hours first and then from hour to hour, so that no task sorts a whole one.
    """
    attributes = canonical_json(F.col("attributes"))
    known = F.when(F.col("temporality").isin("delta", "cumulative"), F.col("temporality")).otherwise(F.raise_error(F.concat(
        F.lit("histogram "), F.coalesce("metric", F.lit("")), F.lit(" has points that are neither delta nor cumulative"))))
    counts = F.when(F.size("bucket_counts") == F.size("explicit_bounds") + 1, F.col("bucket_counts")).otherwise(F.raise_error(F.concat(
        F.lit("histogram "), F.coalesce("metric", F.lit("")), F.lit(" has points whose counts do not fit their bounds"))))
    points = points.withColumns({"temporality": known, "bucket_counts": counts})
    delta = points.where("temporality = 'delta'")
    key = ["metric", "service", "_attributes", "explicit_bounds"]
    total = F.aggregate("bucket_counts", F.lit(0).cast("bigint"), lambda a, c: a + c)
    running = points.where("temporality = 'cumulative'").withColumns({
        "_attributes": attributes, "_cell": times.floor_div(F.col("point_time"), NS_PER_HOUR), "_at": F.struct("point_time", total.alias("n"))})
    inside = Window.partitionBy(*key, "_cell").orderBy("_at")
    within = running.withColumn("bucket_counts", _grown(F.col("bucket_counts"), F.lag("bucket_counts").over(inside)))
    # The first point of every hour against the last one of the hour before that has any.
    edges = running.groupBy(*key, "_cell").agg(
        *[F.min_by(c, "_at").alias(c) for c in points.columns if c not in key],
        F.max_by("bucket_counts", "_at").alias("_last"))
    across = edges.withColumn("bucket_counts", _grown(
        F.col("bucket_counts"), F.lag("_last").over(Window.partitionBy(*key).orderBy("_cell"))))
    return delta.unionByName(within.where("bucket_counts is not null").select(*columns(points.columns))).unionByName(
        across.where("bucket_counts is not null").select(*columns(points.columns)))


def _upto(bounds: Column, counts: Column, x: Column) -> Column:
    """Observations up to ``x``, those of a bucket spread evenly over it; overflow lies above every bound.

    The first bucket begins at 0, or if its bound is not positive, lies at the bound.
    """
    whole = F.size(F.filter(bounds, lambda b: b <= x))
    below = F.aggregate(F.slice(counts, F.lit(1), whole), F.lit(0.0), lambda a, c: a + c)
    upper = F.get(bounds, whole)
    lower = F.when(whole > 0, F.get(bounds, whole - 1)).when(upper > 0, F.lit(0.0))
    inside = F.when((upper > lower) & (x > lower), F.get(counts, whole) * (x - lower) / (upper - lower))
    return below + F.coalesce(inside, F.lit(0.0))


def histogram_merge(points: DataFrame, group_by: list[str]) -> DataFrame:
    """Observations of a histogram table added up per label set: ``g0..gN``, ``bounds``, ``counts`` (doubles).

    Cumulative points count by what they gained, see ``histogram_increase``. Points of one set of bounds are added
    bucket by bucket. Where a group has several such sets, all are carried over to the bounds of all of them, by even
    spread inside each bucket, as ``histogram_quantile`` takes it. Lists hold one entry per bucket.
    """
    groups = [f"g{i}" for i in range(len(group_by))]
    rows = histogram_increase(points)
    buckets = rows.select(*group_columns(rows, group_by), "explicit_bounds", F.posexplode("bucket_counts").alias("i", "n"))
    layouts = buckets.groupBy(*groups, "explicit_bounds", "i").agg(F.sum("n").cast("double").alias("n")).groupBy(
        *groups, "explicit_bounds").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "n"))), lambda e: e["n"]).alias("counts"))
    # One row per layout of a group; gathered, they are as many numbers as the group has different buckets.
    gathered = layouts.groupBy(*groups).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("explicit_bounds")))).alias("bounds"),
        F.collect_list(F.struct("explicit_bounds", "counts")).alias("parts"))
    if not groups:  # an aggregate without keys answers even for no rows
        gathered = gathered.where(F.size("parts") > 0)
    upto = F.transform("bounds", lambda x: F.aggregate(
        "parts", F.lit(0.0), lambda a, p: a + _upto(p["explicit_bounds"], p["counts"], x)))
    over = F.aggregate("parts", F.lit(0.0), lambda a, p: a + F.element_at(p["counts"], -1))
    steps = gathered.select(*groups, "bounds", upto.alias("upto"), over.alias("over"))
    each = F.transform("upto", lambda v, i: v - F.coalesce(F.get("upto", i - 1), F.lit(0.0)))
    return steps.select(*groups, "bounds", F.concat(each, F.array("over")).alias("counts"))

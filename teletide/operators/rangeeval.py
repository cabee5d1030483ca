"""Evaluation on a step grid: instant selectors, counter rates and log counts over time.

For each step ``t = start, start + step, ... end`` a function looks at the window ``(t - range, t]``.
The grid is cut into cells of width ``gcd(step, range)`` whose edges fall on every window edge, so a
window is an exact union of cells. Samples are summarised per (series, cell) first, which a partial
aggregation does before the shuffle.

A window is then described by its earliest and its newest cell. Counts of lines are differences between
running totals over the cells of a series. Counter growth, where a large reading would swallow the small
ones after it, is never subtracted: the cells are taken in blocks as long as a window, which so lies in two
blocks at most, and its growth is the total from its earliest cell to the end of the one and from the
start of the other to its newest cell. Each cell is the newest for a stretch of steps, up to the one where
its successor takes over, and the earliest for another. So the work grows with the cells and the result,
however many steps a window spans.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, Window, functions as F

from teletide.functions import times
from teletide.functions.attrs import json_text, labels_json, series_key
from teletide.model import LOG_COLUMNS, NS_PER_MINUTE, NS_PER_SECOND
from teletide.operators import duplicates
from teletide.operators.logs import LogQuery, filter_logs, query_logs

LOOKBACK = 5 * NS_PER_MINUTE
DEFAULT_LINES = 1000
# Samples of one series within a cell are sorted together, so counter cells are cut into parts this short.
COUNTER_CELL = 10 * NS_PER_MINUTE


@dataclass(frozen=True)
class Grid:
    """Evaluation instants ``start, start + step, ... <= end``, all in nanoseconds."""

    start: int
    end: int
    step: int

    def __post_init__(self) -> None:
        if self.step <= 0:
            raise ValueError("step must be positive")
        if self.end < self.start:
            raise ValueError("the grid ends before it starts")

    @property
    def last(self) -> int:
        """Index of the last step."""
        return (self.end - self.start) // self.step

    def width(self, window: int) -> int:
        """Cell width: the common divisor of step and range."""
        if window <= 0:
            raise ValueError("the range must be positive")
        return gcd(self.step, window)

    def reachable(self, ts: Column, window: int) -> Column:
        """Samples that some window of the grid covers."""
        return (ts > self.start - window) & (ts <= self.start + self.last * self.step)

    def cell(self, ts: Column, width: int, parts: int = 1) -> Column:
        """Number of the cell holding ``ts``; cell c ends at ``start + c * width``, inclusive.

        Cells cut into ``parts`` are numbered through; parts are equally long but for the first of each cell.
        """
        whole = times.ceil_div(ts - F.lit(self.start), width)
        if parts == 1:
            return whole
        left = whole * width + F.lit(self.start) - ts  # to the end of the cell
        return whole * parts - times.floor_div(left, -(-width // parts))

    def reaching(self, cells: DataFrame, window: int, width: int, parts: int = 1) -> DataFrame:
        """Cells that lie in some window, with the first and last step (``_from``, ``_to``) they reach."""
        per_step, per_window = self.step // width * parts, window // width * parts
        first = F.greatest(times.ceil_div(F.col("cell"), per_step), F.lit(0))
        last = F.least(times.floor_div(F.col("cell") + F.lit(per_window - 1), per_step), F.lit(self.last))
        return cells.withColumns({"_from": first, "_to": last}).where("_from <= _to")

    def newest(self, cells: DataFrame, series: str) -> DataFrame:
        """Each reaching cell at the steps (``ts``) whose window it is the newest of."""
        following = F.lead("_from").over(Window.partitionBy(series).orderBy("cell"))
        return self._at(cells, F.col("_from"), F.least(F.col("_to"), following - 1))

    def earliest(self, cells: DataFrame, series: str) -> DataFrame:
        """Each reaching cell at the steps whose window it is the earliest of."""
        preceding = F.lag("_to").over(Window.partitionBy(series).orderBy("cell"))
        return self._at(cells, F.greatest(F.col("_from"), preceding + 1), F.col("_to"))

    def _at(self, cells: DataFrame, first: Column, last: Column) -> DataFrame:
        stretch = cells.withColumns({"_first": first, "_last": last}).where("_first <= _last")
        steps = stretch.select("*", F.explode(F.sequence("_first", "_last")).alias("_step"))
        return steps.withColumn("ts", F.lit(self.start) + F.col("_step") * F.lit(self.step))


def _totals(column: str, series: str) -> Column:
    """Running total over the cells of a series."""
    return F.sum(column).over(Window.partitionBy(series).orderBy("cell").rowsBetween(
        Window.unboundedPreceding, 0))


def _ends(grid: Grid, cells: DataFrame, series: str, first: dict[str, Column],
          last: dict[str, Column]) -> DataFrame:
    """Per series and step, ``first`` taken from the earliest cell and ``last`` from the newest."""
    early = grid.earliest(cells, series).select(series, "ts", *[c.alias(n) for n, c in first.items()])
    late = grid.newest(cells, series).select(series, "ts", *[c.alias(n) for n, c in last.items()])
    both = early.unionByName(late, allowMissingColumns=True)
    # One row of each kind per step, so any aggregate that skips NULL joins them.
    return both.groupBy(series, "ts").agg(*[F.max(n).alias(n) for n in [*first, *last]])


def named(metric: str) -> Column:
    """Rows of a metric by its stored name, or by its name with underscores for dots.

    The spellings an underscored name may stand for are listed, so that the test reaches the scan;
    only a name with many underscores is compared after the replacement.
    """
    if "." in metric:
        return F.col("metric") == metric
    parts = metric.split("_")
    if len(parts) > 7:
        return F.replace(F.col("metric"), F.lit("."), F.lit("_")) == metric
    spellings = [""]
    for i, part in enumerate(parts):
        joints = ["_", "."] if i else [""]
        spellings = [s + joint + part for s in spellings for joint in joints]
    return F.col("metric").isin(spellings)


def _unambiguous(rows: DataFrame, metric: str) -> DataFrame:
    """``rows`` of a metric asked for with underscores; a read that meets two stored names for it fails, naming both.

    The names are told by a subquery that reads no other column than the metric and what the rows are filtered by.
    """
    if "_" not in metric:
        return rows
    low, high = (rows.select(f("metric").alias("metric")).scalar() for f in (F.min, F.max))
    clash = F.raise_error(F.concat(F.lit("metrics "), low, F.lit(" and "), high, F.lit(" share one query name")))
    return rows.where(F.when(low < high, clash.cast("boolean")).otherwise(True))


def labelled(points: DataFrame) -> DataFrame:
    """Points with their series identity as canonical JSON in ``labels``.

    A table written with a ``series`` column saves parsing the attributes of every row.
    """
    if "series" in points.columns:
        labels = F.col("series")
    else:
        labels = series_key(F.col("service"), F.col("metric"), F.col("attributes"))
    return points.select(labels.alias("labels"), F.col("point_time"), F.col("value"))


def _samples(points: DataFrame, metric: str, grid: Grid, window: int, policy: str) -> DataFrame:
    """One value per (series, instant) of a metric, given by stored or underscored name."""
    rows = times.in_range(points, "point_time", grid.start - window + 1, grid.end + 1)
    rows = labelled(_unambiguous(rows.where(named(metric) & grid.reachable(F.col("point_time"), window)), metric))
    return duplicates.resolve(rows, policy, ["labels"])


def instant_selector(points: DataFrame, metric: str, grid: Grid, lookback: int = LOOKBACK,
                     policy: str = duplicates.ERROR_ON_READ) -> DataFrame:
    """Newest sample at most ``lookback`` old at every step: ``labels``, ``ts``, ``value``."""
    samples = _samples(points, metric, grid, lookback, policy)
    width = grid.width(lookback)
    cells = samples.groupBy("labels", grid.cell(F.col("point_time"), width).alias("cell")).agg(
        F.max_by("value", "point_time").alias("value"))
    return grid.newest(grid.reaching(cells, lookback, width), "labels").select("labels", "ts", "value")


def _counter_delta(now: Column, before: Column) -> Column:
    """Growth of a counter since the sample before; a drop means it started again from zero."""
    return F.when(before.isNull(), 0.0).when(now >= before, now - before).otherwise(now)


def _counter_windows(points: DataFrame, metric: str, grid: Grid, window: int, policy: str) -> DataFrame:
    """Per series and step: sample count, first and last sample, reset-corrected growth.

    Growth inside a cell comes from a window over (series, cell); growth between neighbouring cells
    is added on the summaries. A long or busy series is thus cut at the cell edges, and its cells at the
    edges of blocks.
    """
    width = grid.width(window)
    parts = -(-width // COUNTER_CELL)
    value = F.col("value")
    bad = F.isnan(value) | (F.abs(value) == float("inf"))
    # Such samples are counted and left out of the growth.
    samples = _samples(points, metric, grid, window, policy).withColumns({
        "cell": grid.cell(F.col("point_time"), width, parts),
        "bad": bad.cast("int"), "value": F.when(~bad, value)})
    inside = Window.partitionBy("labels", "cell").orderBy("point_time")
    before = F.lag("value").over(inside)
    samples = samples.withColumn("delta", _counter_delta(F.col("value"), before))
    cells = samples.groupBy("labels", "cell").agg(
        F.count("*").alias("n"),
        F.sum("bad").alias("bad"),
        F.coalesce(F.sum("delta"), F.lit(0.0)).alias("grown"),
        F.min("point_time").alias("first_at"),
        F.min_by("value", "point_time").alias("first_value"),
        F.max("point_time").alias("last_at"),
        F.max_by("value", "point_time").alias("last_value"))
    cells = grid.reaching(cells, window, width, parts)
    previous = F.lag("last_value").over(Window.partitionBy("labels").orderBy("cell"))
    crossed = F.coalesce(_counter_delta(F.col("first_value"), previous), F.lit(0.0))
    cells = cells.withColumns({"crossed": crossed, "block": times.floor_div(F.col("cell"), window // width * parts)})
    ends = _ends(grid, _in_blocks(cells), "labels", first={
        "first_at": F.col("first_at"), "first_value": F.col("first_value"), "first_block": F.col("block"),
        "opens": F.col("opens"), **{f"{c}_from": F.col(f"{c}_from") for c in ("n", "bad", "gain")},
    }, last={"last_at": F.col("last_at"), "last_block": F.col("block"), "entered": F.col("entered"),
             **{f"{c}_upto": F.col(f"{c}_upto") for c in ("n", "bad", "gain")}})

    def total(name: str, between: Column) -> Column:
        """Over the window. One that begins inside a block holds the rest of it; of its earliest cell only
        what came after its first sample counts."""
        one = F.when(F.col("opens"), F.col(f"{name}_upto")).otherwise(F.col(f"{name}_from"))
        return F.when(F.col("first_block") == F.col("last_block"), one).otherwise(
            F.col(f"{name}_from") + between + F.col(f"{name}_upto"))
    growth = F.when(total("bad", F.lit(0)) > 0, float("nan")).otherwise(total("gain", F.col("entered")))
    return ends.withColumns({"growth": growth, "n": total("n", F.lit(0))})


def _in_blocks(cells: DataFrame) -> DataFrame:
    """Totals of each cell with those before it in its block (``_upto``) and those after it (``_from``).

    ``opens`` marks the first cell of a block, whose growth since the cell before, ``entered``, is in neither.
    """
    block = Window.partitionBy("labels", "block")
    before = block.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    after = block.orderBy("cell").rowsBetween(1, Window.unboundedFollowing)
    opens = F.col("cell") == F.first("cell").over(before)
    gain = F.col("grown") + F.when(F.col("_opens"), 0.0).otherwise(F.col("crossed"))
    cells = cells.withColumn("_opens", opens).withColumn("_gain", gain)
    both = {f"{name}_{end}": total for name, own, all_ in (("n", "n", "n"), ("bad", "bad", "bad"), ("gain", "grown", "_gain"))
            for end, total in (("upto", F.sum(all_).over(before)),
                               ("from", F.col(own) + F.coalesce(F.sum(all_).over(after), F.lit(0).cast("double" if own == "grown" else "long"))))}
    return cells.withColumns({**both, "opens": F.col("_opens"), "entered": F.first("crossed").over(before)})


def increase(points: DataFrame, metric: str, window: int, grid: Grid,
             policy: str = duplicates.ERROR_ON_READ) -> DataFrame:
    """Growth of a counter over each window, extrapolated to the window's edges.

    Needs two samples. Each edge is extended by the distance to it when that is below 1.1 times the
    mean sample gap, else by half a gap, and never back beyond the instant the counter was zero.
    """
    w = _counter_windows(points, metric, grid, window, policy).where("n >= 2")
    sampled = (F.col("last_at") - F.col("first_at")).cast("double")
    gap = sampled / (F.col("n") - 1)
    to_start = (F.col("first_at") - (F.col("ts") - F.lit(window))).cast("double")
    to_end = (F.col("ts") - F.col("last_at")).cast("double")
    limited = lambda d: F.when(d >= gap * 1.1, gap / 2).otherwise(d)
    since_zero = F.when((F.col("growth") > 0) & (F.col("first_value") >= 0),
                        sampled * F.col("first_value") / F.col("growth"))
    extended = sampled + F.least(limited(to_start), since_zero) + limited(to_end)
    return w.select("labels", "ts", (F.col("growth") * extended / sampled).alias("value"))


def rate(points: DataFrame, metric: str, window: int, grid: Grid,
         policy: str = duplicates.ERROR_ON_READ) -> DataFrame:
    """``increase`` per second."""
    per_second = F.col("value") / F.lit(window / NS_PER_SECOND)
    return increase(points, metric, window, grid, policy).withColumn("value", per_second)


def aggregate_by(series: DataFrame, by: list[str], how: str = "sum") -> DataFrame:
    """Combine the series of a grid result that agree on the labels ``by``."""
    combine = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max,
               "count": lambda c: F.count(c).cast("double")}[how]
    groups = [F.coalesce(json_text(F.col("labels"), k), F.lit("")).alias(f"g{i}")
              for i, k in enumerate(by)]
    return series.groupBy("ts", *groups).agg(combine("value").alias("value")).select(
        labels_json(by).alias("labels"), "ts", "value")


def resolve_names(catalog: DataFrame) -> DataFrame:
    """Query name, stored name and kind of every metric of a catalog.

    Two stored names that read the same after the replacement of dots fail the query.
    """
    kind = F.when(F.col("kind") == "sum", "counter").when(
        F.col("kind") == "histogram", "cumulative_histogram").otherwise("gauge")
    names = catalog.groupBy(F.replace(F.col("metric"), F.lit("."), F.lit("_")).alias("query_name")).agg(
        F.min("metric").alias("stored_name"), F.max("metric").alias("other"), F.min(kind).alias("kind"))
    clash = F.raise_error(F.concat(
        F.lit("metrics "), F.col("stored_name"), F.lit(" and "), F.col("other"),
        F.lit(" share one query name"))).cast("string")
    return names.select("query_name", F.when(
        F.col("stored_name") != F.col("other"), clash).otherwise(F.col("stored_name")).alias(
        "stored_name"), "kind")


def log_lines(logs: DataFrame, service: str = "", contains: str = "", start: int = 0, end: int = 0,
              limit: int = DEFAULT_LINES) -> DataFrame:
    """Lines of the streams with this service that contain a text."""
    return query_logs(logs, LogQuery(service=service, contains=contains, start=start, end=end,
                                     limit=limit)).select(*LOG_COLUMNS)


def count_over_time(logs: DataFrame, window: int, grid: Grid, service: str = "",
                    contains: str = "") -> DataFrame:
    """Lines per stream in the window of every step: ``labels``, ``ts``, ``value``."""
    rows = filter_logs(logs, LogQuery(service=service, contains=contains))
    rows = times.in_range(rows, "time", grid.start - window + 1, grid.end + 1).where(
        grid.reachable(F.col("time"), window))
    width = grid.width(window)
    cells = rows.groupBy(F.coalesce("service", F.lit("")).alias("g0"),
                         grid.cell(F.col("time"), width).alias("cell")).agg(F.count("*").alias("n"))
    cells = grid.reaching(cells, window, width).withColumn("upto", _totals("n", "g0"))
    ends = _ends(grid, cells, "g0", first={"before": F.col("upto") - F.col("n")},
                 last={"upto": F.col("upto")})
    count = (F.col("upto") - F.col("before")).cast("double")
    return ends.select(labels_json(["service"]).alias("labels"), "ts", count.alias("value"))


def log_rate(logs: DataFrame, window: int, grid: Grid, service: str = "",
             contains: str = "") -> DataFrame:
    """Lines per second."""
    return count_over_time(logs, window, grid, service, contains).withColumn(
        "value", F.col("value") / F.lit(window / NS_PER_SECOND))

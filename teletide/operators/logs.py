"""Log queries: filters, ordering, paging, counts and volume."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, functions as F

from teletide.functions import text, times
from teletide.functions.attrs import group_columns, labels_json
from teletide.model import LOG_COLUMNS, NS_PER_MINUTE, NS_PER_SECOND
from teletide.operators import predicates
from teletide.operators.predicates import AttrFilter
from teletide.operators.ranking import with_position

TIME = "time"
OBSERVED_TIME = "observed_time"
# Up to this many rows the head of an order is merged in one task; beyond it positions are counted.
MERGED_ROWS = 100_000


@dataclass(frozen=True)
class LogQuery(AttrFilter):
    """Which logs to take; every unset field takes all."""

    service: str = ""
    match: str = ""                 # full-text terms, all of which must occur in the body
    contains: str = ""              # plain substring of the body
    trace_id: str = ""
    span_id: str = ""
    severity_at_least: int = 0
    start: int = 0                  # event time, inclusive
    end: int = 0                    # event time, exclusive
    observed_after: int = 0         # arrival time, exclusive; rows without one never match
    order_by: str = TIME            # time or observed_time
    backward: bool = False
    limit: int = 0
    tie_break: list[str] = field(default_factory=lambda: ["record_id"])


def _axis(q: LogQuery) -> str:
    axis = q.order_by or TIME
    if axis not in (TIME, OBSERVED_TIME):
        raise ValueError(f"unknown log order axis {axis!r}")
    return axis


def filter_logs(logs: DataFrame, q: LogQuery) -> DataFrame:
    """Rows matching every condition of ``q``, in no order."""
    _axis(q)
    conditions = predicates.equal_if_set(service=q.service)
    if q.trace_id:
        conditions.append(F.col("trace_id") == predicates.hex_id(q.trace_id, 32))
    if q.span_id:
        conditions.append(F.col("span_id") == predicates.hex_id(q.span_id, 16))
    if q.severity_at_least > 0:
        conditions.append(F.col("severity_number") >= q.severity_at_least)
    if q.observed_after:
        conditions.append(F.col("observed_time") > q.observed_after)
    conditions += predicates.attr_conditions(logs, q)
    if q.contains:
        conditions.append(F.contains(F.col("body"), F.lit(q.contains)))
    if q.match:
        conditions.append(text.matches(F.col("body"), q.match))
    return times.in_range(logs, "time", q.start, q.end).where(predicates.all_of(conditions))


def order_columns(q: LogQuery) -> list[Column]:
    """Sort keys along the chosen axis. Rows without an arrival time come last either way."""
    direction = (lambda c: F.desc_nulls_last(c)) if q.backward else (lambda c: F.asc_nulls_last(c))
    axis = _axis(q)
    keys = [axis] if axis == TIME else [axis, TIME]
    return [direction(k) for k in [*keys, *q.tie_break]]


def query_logs(logs: DataFrame, q: LogQuery) -> DataFrame:
    """Matching rows in order. With a limit Spark keeps only the best rows of each partition."""
    return _slice(logs, q, 0, q.limit)


def _slice(logs: DataFrame, q: LogQuery, after: int, limit: int) -> DataFrame:
    """``limit`` rows (0: all) of the ordered result behind the first ``after``."""
    order = order_columns(q)
    if 0 < limit and after + limit > MERGED_ROWS:
        placed = positions(logs, q, "_rn").where(
            (F.col("_rn") > after) & (F.col("_rn") <= after + limit))
        return placed.select(*LOG_COLUMNS, *q.tie_break).orderBy(*order)
    rows = filter_logs(logs, q).select(*LOG_COLUMNS, *q.tie_break).orderBy(*order)
    return rows.offset(after).limit(limit) if limit > 0 else rows


def positions(logs: DataFrame, q: LogQuery, name: str = "rn") -> DataFrame:
    """Every matching row with its 1-based position in the order of ``q``.

    The order is that of ``order_columns``; see ``ranking.with_position`` for how it is split. A hot
    instant is cut further along the first tie-break column if that is a number, by its high bits first,
    so that consecutive and hashed ids both spread.
    """
    sign = -1 if q.backward else 1
    time = F.col("time") * sign
    if _axis(q) == TIME:
        blocks, key = [], time
    else:
        # Rows without an arrival time form a second block, ordered by event time.
        key = F.coalesce("observed_time", "time") * sign
        blocks = [F.col("observed_time").isNull()]
    digits = [*blocks, times.floor_div(key, NS_PER_MINUTE), times.floor_div(key, NS_PER_SECOND // 100)]
    rows = filter_logs(logs, q)
    fine = [key, time]
    if q.tie_break and rows.schema[q.tie_break[0]].dataType.typeName() in ("long", "integer"):
        tie = F.col(q.tie_break[0]).cast("bigint")
        fine += [times.floor_div(tie, 1 << bits) * sign for bits in (48, 32, 16)]
    return with_position(rows, order_columns(q), digits, name=name, fine=fine, nulls_last=True)


def count_logs(logs: DataFrame, q: LogQuery) -> DataFrame:
    """Number of matching rows, whatever the limit and direction."""
    return filter_logs(logs, q).agg(F.count("*").alias("count"))


def log_volume(logs: DataFrame, q: LogQuery, step: int, group_by: list[str] | None = None) -> DataFrame:
    """Rows per epoch-aligned time bucket and label set."""
    keys = list(group_by or [])
    rows = filter_logs(logs, q)
    grouped = rows.groupBy(times.bucket(F.col("time"), step).alias("bucket_time"),
                           *group_columns(rows, keys)).agg(F.count("*").alias("count"))
    return grouped.select("bucket_time", labels_json(keys).alias("labels"), "count")


@dataclass
class LogPage:
    """One page of rows and, once the rows were read by an action, its size and successor."""

    rows: DataFrame
    observation: Observation
    offset: int
    limit: int

    @property
    def returned(self) -> int:
        return self.observation.get["returned"]

    @property
    def next_offset(self) -> int | None:
        """Where the next page starts; None when this page was not full."""
        full = self.limit > 0 and self.returned >= self.limit
        return self.offset + self.returned if full else None


def log_page(logs: DataFrame, q: LogQuery, after: int = 0) -> LogPage:
    """Page of ``q.limit`` rows that starts after the first ``after`` rows."""
    if q.limit <= 0:
        raise ValueError("a page needs a limit")
    seen = Observation()
    rows = _slice(logs, q, after, q.limit).observe(seen, F.count(F.lit(1)).alias("returned"))
    return LogPage(rows, seen, after, q.limit)


def log_page_after(logs: DataFrame, q: LogQuery, last: dict[str, int]) -> DataFrame:
    """The page that follows the row with the given axis, ``time`` and tie-break values.

    Unlike an offset this costs the same however deep the page is: the bound on the axis reaches the
    scan and every partition keeps at most ``q.limit`` rows.
    """
    axis = _axis(q)
    beyond = (lambda c, v: F.col(c) < v) if q.backward else (lambda c, v: F.col(c) > v)
    keys = list(dict.fromkeys([axis, TIME, *q.tie_break]))
    after = F.lit(False)
    for i, key in enumerate(keys):
        same = predicates.all_of([F.col(k).eqNullSafe(F.lit(last[k])) for k in keys[:i]])
        # A missing value is the last of its column either way.
        step = F.lit(False) if last[key] is None else beyond(key, last[key]) | F.col(key).isNull()
        after = after | (same & step)
    after = F.coalesce(after, F.lit(False))
    if last[axis] is None:
        return query_logs(logs.where(F.col(axis).isNull() & after), q)
    reachable = F.col(axis) <= last[axis] if q.backward else F.col(axis) >= last[axis]
    return query_logs(logs.where((reachable | F.col(axis).isNull()) & after), q)

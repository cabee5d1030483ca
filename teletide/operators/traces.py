"""Span filters, request metrics, trace search, trace trees and the joins between signals."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from teletide.functions import times
from teletide.functions.attrs import columns, group_columns
from teletide.model import NS_PER_SECOND
from teletide.operators import predicates, trees
from teletide.operators.predicates import AttrFilter
from teletide.operators.quantiles import SPLIT_ABOVE, group_quantiles
from teletide.operators.ranking import with_position
from teletide.session import materialize, materialize_small

LATENCIES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
SPANS_PER_LIST = 10_000
# Spans of the longest trace that one task places by itself.
TREE_IN_TASK = 50_000
# Trace ids that a scan is given as values, for its Bloom filters; Parquet takes no more by default.
NAMED_IDS = 10


@dataclass(frozen=True)
class TraceQuery(AttrFilter):
    """Predicates one span of a trace must meet together."""

    service: str = ""
    name: str = ""
    status: str = ""
    kind: str = ""
    min_duration_ns: int = 0
    max_duration_ns: int = 0
    start: int = 0
    end: int = 0
    limit: int = 0


@dataclass(frozen=True)
class SpanMetricsQuery:
    step: int
    service: str = ""
    name: str = ""
    kind: str = ""
    status: str = ""
    group_by: list[str] = field(default_factory=list)
    start: int = 0
    end: int = 0


def span_condition(spans: DataFrame, q: TraceQuery) -> Column:
    """Whether a span meets every predicate of ``q``; a NULL comparison does not."""
    conditions = predicates.equal_if_set(
        service=q.service, name=q.name, status_code=q.status, kind=q.kind)
    if q.min_duration_ns > 0:
        conditions.append(F.col("duration_ns") >= q.min_duration_ns)
    if q.max_duration_ns > 0:
        conditions.append(F.col("duration_ns") <= q.max_duration_ns)
    if q.start:
        conditions.append(F.col("start_time") >= q.start)
    if q.end:
        conditions.append(F.col("start_time") < q.end)
    return predicates.all_of(conditions + predicates.attr_conditions(spans, q))


def filter_spans(spans: DataFrame, q: TraceQuery) -> DataFrame:
    return times.in_range(spans, "start_time", q.start, q.end).where(span_condition(spans, q))


# --- Request, error and latency metrics ------------------------------------------------------------


def _red_rows(spans: DataFrame, q: SpanMetricsQuery) -> DataFrame:
    rows = filter_spans(spans, TraceQuery(service=q.service, name=q.name, kind=q.kind,
                                          status=q.status, start=q.start, end=q.end))
    return rows.select(
        times.bucket(F.col("start_time"), q.step).alias("bucket"),
        *group_columns(rows, q.group_by),
        "duration_ns", (F.col("status_code") == "ERROR").alias("failed"))


def span_metrics(spans: DataFrame, q: SpanMetricsQuery, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """Calls, errors and exact latency percentiles per step and label set. Groups of more than
    ``split_above`` spans are worked on in parts."""
    groups = ["bucket", *[f"g{i}" for i in range(len(q.group_by))]]
    red = group_quantiles(_red_rows(spans, q), groups, "duration_ns", LATENCIES,
                          {"errors": F.count_if("failed")}, split_above)
    return red.withColumnRenamed("count", "calls")


def span_metrics_approx(spans: DataFrame, q: SpanMetricsQuery, accuracy: int = 10_000) -> DataFrame:
    """The same with sketched percentiles: one pass and one shuffle of bounded buffers."""
    groups = ["bucket", *[f"g{i}" for i in range(len(q.group_by))]]
    ps = F.percentile_approx("duration_ns", list(LATENCIES.values()), accuracy)
    red = _red_rows(spans, q).groupBy(*groups).agg(
        F.count("*").alias("calls"), F.count_if("failed").alias("errors"), ps.alias("ps"))
    return red.select(*groups, "calls", "errors", *[
        F.get("ps", i).cast("double").alias(name) for i, name in enumerate(LATENCIES)])


# --- Single traces and search ----------------------------------------------------------------------


def get_trace(spans: DataFrame, trace_id: str, index: DataFrame | None = None) -> DataFrame:
    """Spans of one trace by start."""
    wanted = F.col("trace_id") == predicates.hex_id(trace_id, 32)
    days = None if index is None else index.where(wanted)
    return on_days(spans, days).where(wanted).orderBy("start_time", "span_id")


def on_days(spans: DataFrame, entries: DataFrame | None) -> DataFrame:
    """``spans`` of a stored table, on the days that some entries of its trace index name.

    The days become a filter on the partitions before the scan is planned; the driver gets one value for each
    day at most, as many as the table has folders. Without entries or days all of them are read.
    """
    if entries is None or "day" not in spans.columns:
        return spans
    days = [r["day"] for r in entries.select("day").distinct().collect()]
    dated = F.col("day").isin([d for d in days if d is not None])
    return spans.where(dated | F.col("day").isNull() if None in days else dated)


def _indexed(spans: DataFrame, ids: DataFrame, index: DataFrame | None) -> DataFrame:
    """``spans`` without the files that the index, or the Bloom filters of a few ids, can pass over."""
    if index is None:
        return spans
    named = [r["trace_id"] for r in ids.select("trace_id").limit(NAMED_IDS + 1).collect()]
    if len(named) > NAMED_IDS:
        return on_days(spans, index.join(F.broadcast(ids), "trace_id", "left_semi"))
    return on_days(spans, index.where(F.col("trace_id").isin(named))).where(F.col("trace_id").isin(named))


def _traces_of(matching: DataFrame) -> tuple[DataFrame, bool]:
    """Ids of the traces of some spans, and whether they can be broadcast."""
    return materialize_small(matching.select("trace_id").distinct(), "trace-ids")


def search_traces(spans: DataFrame, q: TraceQuery, index: DataFrame | None = None) -> DataFrame:
    """Summaries of the traces in which one span meets ``q``, newest first.

    The summary covers the whole trace; its root is the earliest span without a parent. The matching
    trace ids are found first, with the predicates pushed to the scan. If they are few, only their
    spans are summarised; if not, the predicate is aggregated along with the summary of all traces,
    which moves one partial row per trace and task and needs no join. With the trace index of a stored
    table, the second scan of few traces reads only their days.
    """
    spans = spans.where(F.col("trace_id").isNotNull())  # a span without one is in no trace
    ids, few = _traces_of(filter_spans(spans, q))
    if few:
        rows = _indexed(spans, ids, index).join(F.broadcast(ids), "trace_id", "left_semi").withColumn("_hit", F.lit(True))
    else:
        rows = spans.withColumn("_hit", F.coalesce(span_condition(spans, q), F.lit(False)))
    is_root = F.col("parent_span_id").isNull() | (F.col("parent_span_id") == "")
    root = F.min(F.when(is_root, F.struct("start_time", "span_id", "service", "name")))
    summary = rows.groupBy("trace_id").agg(
        root.alias("root"),
        F.min("start_time").alias("start_time"),
        F.max(F.col("start_time") + F.col("duration_ns")).alias("end_time"),
        F.count("*").alias("span_count"),
        F.coalesce(F.bool_or(F.col("status_code") == "ERROR"), F.lit(False)).alias("error"),
        F.bool_or("_hit").alias("hit"))
    found = summary.where("hit").select(
        "trace_id", F.col("root.service").alias("root_service"), F.col("root.name").alias("root_name"),
        "start_time", (F.col("end_time") - F.col("start_time")).alias("duration_ns"),
        "span_count", "error").orderBy(F.desc("start_time"), "trace_id")
    return found.limit(q.limit) if q.limit > 0 else found


def spanset_match(spans: DataFrame, q: TraceQuery, start: int = 0, end: int = 0,
                  index: DataFrame | None = None) -> DataFrame:
    """Spans selected by ``q`` in traces that begin in [start, end): ``trace_id``, ``span_id``."""
    spans = spans.where(F.col("trace_id").isNotNull())
    selected = filter_spans(spans, q)
    if not start and not end:
        return selected.select("trace_id", "span_id", "start_time")
    # No span starts before its trace does.
    selected = times.in_range(selected, "start_time", start).select("trace_id", "span_id", "start_time")
    ids, few = _traces_of(selected)
    candidates = _indexed(spans, ids, index).join(F.broadcast(ids), "trace_id", "left_semi") if few else spans
    begins = candidates.groupBy("trace_id").agg(F.min("start_time").alias("begin"))
    return selected.join(times.in_range(begins, "begin", start, end), "trace_id", "left_semi")


def _instants() -> list[Column]:
    """How the spans of a hot group are cut up along their start and, within an instant, their id."""
    letters = [F.ascii(F.substring("span_id", i, 1)) for i in (1, 2, 3, 4)]
    return [times.floor_div(F.col("start_time"), NS_PER_SECOND), F.col("start_time"), *letters]


def spanset_lists(matches: DataFrame, per_list: int = SPANS_PER_LIST) -> DataFrame:
    """The selected span ids of each trace, by start, in lists of ``per_list`` numbered by ``part``.

    A trace of fewer takes one row. The bound keeps the spans of a huge trace out of one buffer.
    """
    matches = materialize(matches.select("trace_id", "span_id", "start_time"), "matches")
    ranked = with_position(
        matches, [F.col("start_time"), F.col("span_id")], [], group=["trace_id"], fine=_instants())
    part = times.floor_div(F.col("rn") - 1, per_list).alias("part")
    entry = F.array_sort(F.collect_list(F.struct("rn", "span_id")))
    return ranked.groupBy("trace_id", part).agg(entry.alias("e")).select(
        "trace_id", "part", F.col("e.span_id").alias("span_ids"))


def spans_of(spans: DataFrame, matches: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """All spans of the matched traces."""
    if index is None:
        return spans.join(matches.select("trace_id").distinct(), "trace_id", "left_semi")
    ids, few = _traces_of(matches)
    if not few:
        return spans.join(ids, "trace_id", "left_semi")
    return _indexed(spans, ids, index).join(F.broadcast(ids), "trace_id", "left_semi")


# --- Trace trees -----------------------------------------------------------------------------------


def unique_spans(spans: DataFrame) -> DataFrame:
    """One row per (trace, span); of repeats the first by start, then by the other columns.

    An aggregate rather than a numbered window, so that repeats shrink before the shuffle.
    """
    order = ["start_time", "duration_ns", "name", "service", "status_code", "parent_span_id"]
    rest = [c for c in spans.columns if c not in ("trace_id", "span_id", *order)]
    first = spans.groupBy("trace_id", "span_id").agg(
        F.min(F.struct(*order, *columns(rest))).alias("s"))
    return first.select("trace_id", "span_id", "s.*").select(*columns(spans.columns))


def trace_forest(spans: DataFrame, max_rounds: int = 64, in_task: int = TREE_IN_TASK) -> DataFrame:
    """Every span with its root, depth and rank among its siblings, for all traces at once.

    A span without a parent, or whose parent is missing, is a root. Spans on or below a cycle have no
    root: they keep NULL depth and ``in_cycle``. Spans without a trace or span id are in no tree and left out.

    Spans are dealt by trace once, and whole traces of up to ``in_task`` spans are placed where they lie. Longer
    ones are spread over the tasks by span and placed in rounds, see ``_forest_in_rounds``.
    """
    spans = spans.where(F.col("trace_id").isNotNull() & F.col("span_id").isNotNull())
    kept = ["trace_id", "span_id", "parent_span_id", "start_time", "name", "service"]
    nodes = materialize(unique_spans(spans.select(*kept, "duration_ns", "status_code")).select(*kept),
                        "forest-nodes")
    long, few = materialize_small(nodes.groupBy("trace_id").agg(F.count("*").alias("n")).where(
        F.col("n") > in_task).select("trace_id"), "long-traces")
    if long.isEmpty():
        return trees.place(nodes)
    long = F.broadcast(long) if few else long
    return trees.place(nodes.join(long, "trace_id", "left_anti")).unionByName(
        _forest_in_rounds(nodes.join(long, "trace_id", "left_semi"), max_rounds))


def _open_only(targets: DataFrame, active: DataFrame) -> DataFrame:
    """Spans of the traces in which some are still open."""
    traces, few = materialize_small(active.select("trace_id").distinct(), "open-traces")
    return targets.join(F.broadcast(traces) if few else traces, "trace_id", "left_semi")


def _forest_in_rounds(nodes: DataFrame, max_rounds: int) -> DataFrame:
    """Depths by pointer doubling: each round every open span jumps as far as its current ancestor has
    already jumped, so ``k`` rounds resolve depth ``2^k``. A round joins the spans of traces that still have
    open ones, and is written out before the next.
    """
    kept = nodes.columns
    known = nodes.select("trace_id", F.col("span_id").alias("parent_span_id"),
                         F.lit(True).alias("has_parent"))
    linked = materialize(nodes.join(known, ["trace_id", "parent_span_id"], "left").select(
        *kept, F.coalesce("has_parent", F.lit(False)).alias("has_parent")), "forest-links")

    pointer = ["trace_id", "span_id", "up", "dist", "root"]
    done = [linked.where(~F.col("has_parent")).select(
        "trace_id", "span_id", F.lit(None).cast("string").alias("up"),
        F.lit(0).cast("bigint").alias("dist"), F.col("span_id").alias("root"))]
    active = linked.where("has_parent").select(
        "trace_id", "span_id", F.col("parent_span_id").alias("up"),
        F.lit(1).cast("bigint").alias("dist"), F.lit(None).cast("string").alias("root"))
    left_before = None
    for _ in range(max_rounds):
        targets = _open_only(reduce(DataFrame.unionByName, [active, *done]), active).select(
            "trace_id", F.col("span_id").alias("up"), F.col("up").alias("up2"),
            F.col("dist").alias("dist2"), F.col("root").alias("root2"))
        moved = materialize(active.join(targets, ["trace_id", "up"]).select(
            "trace_id", "span_id", F.col("up2").alias("up"),
            (F.col("dist") + F.col("dist2")).alias("dist"), F.col("root2").alias("root")),
            "forest-round")
        done.append(moved.where(F.col("up").isNull()).select(*pointer))
        active = moved.where(F.col("up").isNotNull()).select(*pointer)
        left = active.count()
        # Depths have no gaps, so a round that resolves nothing leaves only cycles.
        if left == 0 or left == left_before:
            break
        left_before = left
    resolved = reduce(DataFrame.unionByName, done).select(
        "trace_id", "span_id", F.col("dist").alias("depth"), F.col("root").alias("root_span_id"))
    siblings = F.when(F.col("has_parent"), F.col("parent_span_id")).otherwise("")
    ranked = with_position(
        linked.withColumn("_siblings", siblings), [F.col("start_time"), F.col("span_id")], [],
        group=["trace_id", "_siblings"], name="sibling_rank", fine=_instants())
    placed = ranked.join(resolved, ["trace_id", "span_id"], "left")
    return placed.select(
        *kept, "root_span_id", "depth", "sibling_rank",
        F.col("depth").isNull().alias("in_cycle"))


# --- Joins between signals -------------------------------------------------------------------------


def logs_with_trace(logs: DataFrame, spans: DataFrame) -> DataFrame:
    """Logs written inside one of the given spans' traces."""
    return logs.where(F.col("trace_id").isNotNull()).join(
        spans.select("trace_id").distinct(), "trace_id", "left_semi")


def logs_without_trace(logs: DataFrame, spans: DataFrame) -> DataFrame:
    """Logs that belong to none of the traces, those without a trace id included.

    Rows without an id skip the join, where they would all meet in one partition.
    """
    traced = logs.where(F.col("trace_id").isNotNull()).join(
        spans.select("trace_id").distinct(), "trace_id", "left_anti")
    return logs.where(F.col("trace_id").isNull()).unionByName(traced)


def exemplar_spans(exemplars: DataFrame, spans: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Each exemplar with the span it points to."""
    linked = exemplars.where(F.col("trace_id").isNotNull() & F.col("span_id").isNotNull())
    wanted, few = materialize_small(linked.select("trace_id", "span_id").distinct(), "span-ids")
    if few:
        spans, wanted = _indexed(spans, wanted.select("trace_id").distinct(), index), F.broadcast(wanted)
    target = unique_spans(spans.join(wanted, ["trace_id", "span_id"], "left_semi")).select(
        "trace_id", "span_id", F.col("name").alias("span_name"), F.col("service").alias("span_service"),
        "start_time", "duration_ns", "status_code")
    return linked.join(target, ["trace_id", "span_id"])

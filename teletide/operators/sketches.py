"""Stored sketches of spans: request metrics that roll up from fine steps to coarse ones without the spans.

One row for each step and label set holds its calls and errors, a KLL sketch of the durations and an HLL sketch of the
trace ids. Sketches of bounded size merge in any order, so a year of minutes answers for hours, days or all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from teletide.functions import times
from teletide.functions.attrs import group_columns
from teletide.operators.traces import LATENCIES, SpanMetricsQuery, TraceQuery, filter_spans

# A KLL sketch of this size misses a rank by less than RANK_ERROR of all values, an HLL sketch a count by less than
# COUNT_ERROR of it; both at six standard errors, for merged sketches too, so that it holds in each of many groups.
KLL_SIZE = 800
RANK_ERROR = 0.01
HLL_BITS = 14
COUNT_ERROR = 0.05


def _groups(sketches: DataFrame) -> list[str]:
    return [c for c in sketches.columns if c not in ("bucket", "calls", "errors", "latency", "traces")]


def span_sketches(spans: DataFrame, q: SpanMetricsQuery) -> DataFrame:
    """``bucket``, ``g0..gN``, ``calls``, ``errors`` and the sketches ``latency`` and ``traces``.

    Partial sketches are made before the shuffle, so a busy service moves one buffer a task.
    """
    rows = filter_spans(spans, TraceQuery(service=q.service, name=q.name, kind=q.kind, status=q.status, start=q.start, end=q.end))
    told = rows.select(times.bucket(F.col("start_time"), q.step).alias("bucket"), *group_columns(rows, q.group_by),
                       "duration_ns", "trace_id", (F.col("status_code") == "ERROR").alias("failed"))
    groups = [f"g{i}" for i in range(len(q.group_by))]
    return told.groupBy("bucket", *groups).agg(
        F.count("*").alias("calls"), F.count_if("failed").alias("errors"),
        F.kll_sketch_agg_bigint("duration_ns", KLL_SIZE).alias("latency"),
        F.hll_sketch_agg("trace_id", HLL_BITS).alias("traces"))


def roll_up(sketches: DataFrame, step: int, coarser: int) -> DataFrame:
    """Sketches of ``step`` brought together in steps of ``coarser``, a multiple of it."""
    if step <= 0 or coarser <= 0 or coarser % step:
        raise ValueError("sketches roll up to a multiple of their step")
    return sketches.groupBy(times.bucket(F.col("bucket"), coarser).alias("bucket"), *_groups(sketches)).agg(
        F.sum("calls").alias("calls"), F.sum("errors").alias("errors"),
        F.kll_merge_agg_bigint("latency").alias("latency"), F.hll_union_agg("traces").alias("traces"))


def answers(sketches: DataFrame) -> DataFrame:
    """Calls, errors, p50, p95 and p99 of the durations and the number of different traces."""
    filled = F.kll_sketch_get_n_bigint("latency") > 0
    ps = [F.when(filled, F.kll_sketch_get_quantile_bigint("latency", F.lit(p)).cast("double")).alias(name)
          for name, p in LATENCIES.items()]
    return sketches.select("bucket", *_groups(sketches), "calls", "errors", *ps, F.hll_sketch_estimate("traces").alias("traces"))

"""The seven telemetry tables: names, schemas and the time axis of each.

All instants are Unix nanoseconds in a LongType column, because Spark timestamps stop at
microseconds. ``attributes`` is a JSON object with sorted keys, so equal text means equal label set.
"""

from __future__ import annotations

from pyspark.sql import types as T

NS_PER_SECOND = 1_000_000_000
NS_PER_MINUTE = 60 * NS_PER_SECOND
NS_PER_HOUR = 3_600 * NS_PER_SECOND
NS_PER_DAY = 86_400 * NS_PER_SECOND

_ATOMS = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
          "string": T.StringType(), "boolean": T.BooleanType()}


def _struct(columns: str | dict[str, T.DataType]) -> T.StructType:
    """``"a bigint, b string"`` as a struct type."""
    pairs = [c.split() for c in columns.split(",")] if isinstance(columns, str) else columns.items()
    return T.StructType([
        T.StructField(name, _ATOMS[kind] if isinstance(kind, str) else kind) for name, kind in pairs])


_LONGS = T.ArrayType(T.LongType())
_DOUBLES = T.ArrayType(T.DoubleType())
_EXEMPLARS = _struct({"exemplars": T.ArrayType(_struct(
    "time bigint, value double, trace_id string, span_id string, attributes string"))})
_POINT = _struct(
    "point_time bigint, metric string, unit string, service string, attributes string, "
    "temporality string, is_monotonic boolean, resource string, scope string")
_TOTALS = _struct("count bigint, sum double")


def _table(*parts: T.StructType) -> T.StructType:
    return T.StructType([f for part in parts for f in part.fields])


LOGS = _struct(
    "time bigint, observed_time bigint, service string, severity_number int, severity_text string, "
    "body string, attributes string, trace_id string, span_id string, resource string, scope string, "
    "record_id bigint")
SPANS = _struct(
    "trace_id string, span_id string, parent_span_id string, name string, kind string, "
    "start_time bigint, duration_ns bigint, status_code string, status_message string, "
    "service string, attributes string, resource string, scope string")
METRICS_GAUGE = _table(_POINT, _struct("value double"), _EXEMPLARS)
METRICS_SUM = METRICS_GAUGE
METRICS_HISTOGRAM = _table(
    _POINT, _TOTALS, _struct({"explicit_bounds": _DOUBLES, "bucket_counts": _LONGS}), _EXEMPLARS)
METRICS_EXP_HISTOGRAM = _table(
    _POINT, _TOTALS, _struct("scale int, zero_count bigint"),
    _struct({"positive_offset": T.IntegerType(), "positive_counts": _LONGS,
             "negative_offset": T.IntegerType(), "negative_counts": _LONGS}), _EXEMPLARS)
METRICS_SUMMARY = _table(
    _POINT, _TOTALS, _struct({"quantile_values": T.ArrayType(_struct("quantile double, value double"))}))

SCHEMAS: dict[str, T.StructType] = {
    "logs": LOGS,
    "spans": SPANS,
    "metrics_gauge": METRICS_GAUGE,
    "metrics_sum": METRICS_SUM,
    "metrics_histogram": METRICS_HISTOGRAM,
    "metrics_exp_histogram": METRICS_EXP_HISTOGRAM,
    "metrics_summary": METRICS_SUMMARY,
}

METRIC_TABLES = [name for name in SCHEMAS if name.startswith("metrics_")]

# Columns returned by the log and point queries, in order.
LOG_COLUMNS = [
    "time", "observed_time", "service", "severity_number", "severity_text",
    "body", "attributes", "trace_id", "span_id",
]
POINT_COLUMNS = ["point_time", "metric", "service", "attributes", "temporality", "is_monotonic"]

# Names no attribute can shadow: model columns plus the derived partition and series columns.
RESERVED = {f.name for s in SCHEMAS.values() for f in s.fields} | {"day", "series"}


def time_column(table: str) -> str:
    """The event-time column of a telemetry table."""
    if table not in SCHEMAS:
        raise ValueError(f"unknown telemetry table {table!r}")
    return {"logs": "time", "spans": "start_time"}.get(table, "point_time")


def metric_kind(table: str) -> str:
    """``metrics_gauge`` -> ``gauge`` and so on, as shown in the metric catalog."""
    return table.removeprefix("metrics_")

"""OTLP/JSON requests built from telemetry tables, the inverse of ``otlp``.

A request holds the records of one service and one chunk key, so its size is bounded by the chunks
the caller chooses rather than by the service.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from teletide.sources.otlp import SERVICE_NAME


def _pairs(attributes: Column) -> Column:
    """A JSON object as an OTLP key-value list."""
    entries = F.map_entries(F.from_json(attributes, "map<string,variant>"))

    def pair(e: Column) -> Column:
        kind, value = F.schema_of_variant(e["value"]), e["value"]
        return F.struct(e["key"].alias("key"), F.struct(
            F.when(kind == "STRING", value.cast("string")).alias("stringValue"),
            F.when(kind == "BIGINT", value.cast("string")).alias("intValue"),
            F.when(kind == "BOOLEAN", value.cast("boolean")).alias("boolValue"),
            F.when(~kind.isin("STRING", "BIGINT", "BOOLEAN"), value.cast("double")).alias("doubleValue"),
        ).alias("value"))

    return F.transform(entries, pair)


def _requests(records: DataFrame, chunk: list[str], outer: str, scope: str, inner: str) -> DataFrame:
    """Records (column ``x``) of one (service, chunk) as one request per row, JSON in ``value``."""
    name = F.struct(F.lit(SERVICE_NAME).alias("key"),
                    F.struct(F.col("service").alias("stringValue")).alias("value"))
    resource = F.struct(F.array(name).alias("attributes")).alias("resource")
    scoped = F.struct(F.struct(F.lit("warehouse").alias("name")).alias("scope"),
                      F.col("xs").alias(inner))
    grouped = records.groupBy("service", *chunk).agg(F.collect_list("x").alias("xs"))
    request = F.struct(F.array(F.struct(resource, F.array(scoped).alias(scope))).alias(outer))
    return grouped.select(F.to_json(request).alias("value"))


def write(payloads: DataFrame, inbox: str) -> None:
    """Add requests, one a line, to a folder of gzip files; plain, the same names and keys in every record would make
    most of the bytes. A reader takes such a file whole, so it is as large as one task's requests."""
    payloads.write.mode("append").option("compression", "gzip").text(inbox)


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def from_logs(logs: DataFrame, per_request: int = 500) -> DataFrame:
    record = F.struct(
        _text("time").alias("timeUnixNano"), _text("observed_time").alias("observedTimeUnixNano"),
        F.col("severity_number").alias("severityNumber"), F.col("severity_text").alias("severityText"),
        F.struct(F.col("body").alias("stringValue")).alias("body"),
        _pairs(F.col("attributes")).alias("attributes"),
        F.col("trace_id").alias("traceId"), F.col("span_id").alias("spanId"))
    chunk = F.call_function("div", F.col("record_id"), F.lit(per_request))
    return _requests(logs.select("service", chunk.alias("chunk"), record.alias("x")),
                     ["chunk"], "resourceLogs", "scopeLogs", "logRecords")


def from_spans(spans: DataFrame) -> DataFrame:
    """Chunks are 4,096 consecutive trace ids."""
    record = F.struct(
        F.col("trace_id").alias("traceId"), F.col("span_id").alias("spanId"),
        F.col("parent_span_id").alias("parentSpanId"), "name",
        F.concat(F.lit("SPAN_KIND_"), F.col("kind")).alias("kind"),
        _text("start_time").alias("startTimeUnixNano"),
        (F.col("start_time") + F.col("duration_ns")).cast("string").alias("endTimeUnixNano"),
        _pairs(F.col("attributes")).alias("attributes"),
        F.struct(F.concat(F.lit("STATUS_CODE_"), F.col("status_code")).alias("code"),
                 F.col("status_message").alias("message")).alias("status"))
    chunk = F.substring("trace_id", 1, 29)
    return _requests(spans.select("service", chunk.alias("chunk"), record.alias("x")),
                     ["chunk"], "resourceSpans", "scopeSpans", "spans")


def _exemplars() -> Column:
    return F.transform("exemplars", lambda e: F.struct(
        e["time"].cast("string").alias("timeUnixNano"), e["value"].alias("asDouble"),
        e["trace_id"].alias("traceId"), e["span_id"].alias("spanId"),
        _pairs(e["attributes"]).alias("filteredAttributes")))


def _point(*own: Column) -> Column:
    return F.struct(_text("point_time").alias("timeUnixNano"),
                    _pairs(F.col("attributes")).alias("attributes"), *own)


def _metrics(points: DataFrame, field: str, point: Column, *own: Column) -> DataFrame:
    """One metric object per point; chunks are the metric and the hour."""
    data = F.struct(F.array(point).alias("dataPoints"), *own)
    metric = F.struct(F.col("metric").alias("name"), "unit", data.alias(field))
    hour = F.call_function("div", F.col("point_time"), F.lit(3_600_000_000_000))
    return _requests(points.select("service", "metric", hour.alias("chunk"), metric.alias("x")),
                     ["metric", "chunk"], "resourceMetrics", "scopeMetrics", "metrics")


def _temporality() -> Column:
    return F.concat(F.lit("AGGREGATION_TEMPORALITY_"), F.upper("temporality")).alias(
        "aggregationTemporality")


def from_gauge(points: DataFrame) -> DataFrame:
    point = _point(F.col("value").alias("asDouble"), _exemplars().alias("exemplars"))
    return _metrics(points, "gauge", point)


def from_sum(points: DataFrame) -> DataFrame:
    return _metrics(points, "sum", _point(F.col("value").alias("asDouble")), _temporality(),
                    F.col("is_monotonic").alias("isMonotonic"))


def from_histogram(points: DataFrame) -> DataFrame:
    point = _point(_text("count").alias("count"), "sum",
                   F.col("bucket_counts").cast("array<string>").alias("bucketCounts"),
                   F.col("explicit_bounds").alias("explicitBounds"))
    return _metrics(points, "histogram", point, _temporality())


def from_exp_histogram(points: DataFrame) -> DataFrame:
    side = lambda s: F.struct(F.col(f"{s}_offset").alias("offset"),
                              F.col(f"{s}_counts").cast("array<string>").alias("bucketCounts")).alias(s)
    point = _point(_text("count").alias("count"), "sum", "scale",
                   _text("zero_count").alias("zeroCount"), side("positive"), side("negative"))
    return _metrics(points, "exponentialHistogram", point, _temporality())


def from_summary(points: DataFrame) -> DataFrame:
    point = _point(_text("count").alias("count"), "sum",
                   F.col("quantile_values").alias("quantileValues"))
    return _metrics(points, "summary", point)

"""OpenTelemetry export requests (OTLP/JSON, one request per line) flattened into table rows.

Field names and enumerations are those of the public OTLP specification: 64-bit integers arrive as
strings, ids as hex, enumerations as numbers or names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from teletide.model import METRIC_TABLES, SCHEMAS

_ANY = ("struct<stringValue:string,intValue:string,doubleValue:double,boolValue:boolean,"
        "arrayValue:string,kvlistValue:string,bytesValue:string>")
_KVS = f"array<struct<key:string,value:{_ANY}>>"
_RESOURCE = f"struct<attributes:{_KVS}>"
_SCOPE = "struct<name:string,version:string>"
_RECORD = ("struct<timeUnixNano:string,observedTimeUnixNano:string,severityNumber:string,"
           f"severityText:string,body:{_ANY},attributes:{_KVS},traceId:string,spanId:string>")
_SPAN = ("struct<traceId:string,spanId:string,parentSpanId:string,name:string,kind:string,"
         f"startTimeUnixNano:string,endTimeUnixNano:string,attributes:{_KVS},"
         "status:struct<code:string,message:string>>")
_EXEMPLAR = ("struct<timeUnixNano:string,asDouble:double,asInt:string,traceId:string,spanId:string,"
             f"filteredAttributes:{_KVS}>")
_POINT = f"timeUnixNano:string,attributes:{_KVS},exemplars:array<{_EXEMPLAR}>"
_NUMBER = f"struct<{_POINT},asDouble:double,asInt:string>"
_HISTOGRAM = (f"struct<{_POINT},count:string,sum:double,bucketCounts:array<string>,"
              "explicitBounds:array<double>>")
_BUCKETS = "struct<offset:int,bucketCounts:array<string>>"
_EXP = (f"struct<{_POINT},count:string,sum:double,scale:int,zeroCount:string,"
        f"positive:{_BUCKETS},negative:{_BUCKETS}>")
_SUMMARY = (f"struct<timeUnixNano:string,attributes:{_KVS},count:string,sum:double,"
            "quantileValues:array<struct<quantile:double,value:double>>>")
_METRIC = (
    "struct<name:string,unit:string,"
    f"gauge:struct<dataPoints:array<{_NUMBER}>>,"
    f"sum:struct<dataPoints:array<{_NUMBER}>,aggregationTemporality:string,isMonotonic:boolean>,"
    f"histogram:struct<dataPoints:array<{_HISTOGRAM}>,aggregationTemporality:string>,"
    f"exponentialHistogram:struct<dataPoints:array<{_EXP}>,aggregationTemporality:string>,"
    f"summary:struct<dataPoints:array<{_SUMMARY}>>>"
)

LOGS_REQUEST = (f"resourceLogs array<struct<resource:{_RESOURCE},"
                f"scopeLogs:array<struct<scope:{_SCOPE},logRecords:array<{_RECORD}>>>>>")
TRACES_REQUEST = (f"resourceSpans array<struct<resource:{_RESOURCE},"
                  f"scopeSpans:array<struct<scope:{_SCOPE},spans:array<{_SPAN}>>>>>")
METRICS_REQUEST = (f"resourceMetrics array<struct<resource:{_RESOURCE},"
                   f"scopeMetrics:array<struct<scope:{_SCOPE},metrics:array<{_METRIC}>>>>>")
REQUESTS = {"logs": LOGS_REQUEST, "traces": TRACES_REQUEST, "metrics": METRICS_REQUEST}

SERVICE_NAME = "service.name"

# Fixed values of the OTLP enumerations.
SPAN_KINDS = ["UNSPECIFIED", "INTERNAL", "SERVER", "CLIENT", "PRODUCER", "CONSUMER"]
STATUS_CODES = ["UNSET", "OK", "ERROR"]
TEMPORALITIES = ["unspecified", "delta", "cumulative"]

# Where each metric table's points lie within a metric.
METRIC_FIELDS = {
    "metrics_gauge": "gauge",
    "metrics_sum": "sum",
    "metrics_histogram": "histogram",
    "metrics_exp_histogram": "exponentialHistogram",
    "metrics_summary": "summary",
}


def read_requests(spark: SparkSession, signal: str, path: str, fail_on_malformed: bool = False) -> DataFrame:
    """Export requests of one signal (logs, traces, metrics) from JSON-lines files. Lines that are no
    request hold no rows; ``receipt`` counts them, ``fail_on_malformed`` makes them an error."""
    mode = "FAILFAST" if fail_on_malformed else "PERMISSIVE"
    return spark.read.schema(REQUESTS[signal]).option("mode", mode).json(path)


def receipt(spark: SparkSession, signal: str, path: str) -> DataFrame:
    """How many lines of the files are requests (``accepted``) and how many are not (``malformed``).
    A line of white space only is neither."""
    broken = "_malformed"
    parsed = F.from_json("value", f"{REQUESTS[signal]}, {broken} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken})
    lines = spark.read.text(path).where(F.trim("value") != "").select(parsed.alias("r"))
    bad = F.col("r").isNull() | F.col("r")[broken].isNotNull()
    return lines.agg(F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("malformed"))


# --- Attribute lists to JSON text ------------------------------------------------------------------


def _quoted(text: Column) -> Column:
    """A string as a JSON literal."""
    wrapped = F.to_json(F.array(text))
    return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)


def _scalar(value: Column) -> Column:
    return (
        F.when(value["stringValue"].isNotNull(), _quoted(value["stringValue"]))
        .when(value["intValue"].isNotNull(), value["intValue"])
        .when(value["doubleValue"].isNotNull(), value["doubleValue"].cast("string"))
        .when(value["boolValue"].isNotNull(), value["boolValue"].cast("string"))
        .when(value["bytesValue"].isNotNull(), _quoted(value["bytesValue"]))
    )


def _nested(value: Column) -> Column:
    """A value inside a list; deeper structures keep their OTLP form."""
    return F.coalesce(_scalar(value), value["arrayValue"], value["kvlistValue"], F.lit("null"))


def _pair(key: Column, value: Column) -> Column:
    return F.concat(_quoted(key), F.lit(":"), value)


def any_json(value: Column) -> Column:
    """JSON text of an OTLP value."""
    array = F.from_json(value["arrayValue"], f"values array<{_ANY}>")["values"]
    members = F.from_json(value["kvlistValue"], f"values {_KVS}")["values"]
    return (
        F.when(value["arrayValue"].isNotNull(), F.concat(
            F.lit("["), F.array_join(F.transform(array, _nested), ","), F.lit("]")))
        .when(value["kvlistValue"].isNotNull(), F.concat(
            F.lit("{"), F.array_join(F.transform(
                F.array_sort(members), lambda m: _pair(m["key"], _nested(m["value"]))), ","),
            F.lit("}")))
        .otherwise(F.coalesce(_scalar(value), F.lit("null")))
    )


def attributes_json(pairs: Column, without: str | None = None) -> Column:
    """A JSON object with sorted keys out of a key-value list."""
    kept = F.filter(pairs, lambda p: p["key"] != without) if without else pairs
    members = F.transform(F.array_sort(kept), lambda p: _pair(p["key"], any_json(p["value"])))
    return F.concat(F.lit("{"), F.coalesce(F.array_join(members, ","), F.lit("")), F.lit("}"))


def _text(value: Column) -> Column:
    """A log body: plain text for strings, JSON for anything else."""
    return F.coalesce(value["stringValue"], F.when(value.isNotNull(), any_json(value)))


# --- Small conversions -----------------------------------------------------------------------------


def _nanos(text: Column) -> Column:
    """A 64-bit instant; zero means it was not set."""
    return F.nullif(text.try_cast("bigint"), F.lit(0))


def _unreadable(*texts: Column) -> Column:
    """Whether one of some 64-bit numbers, which OTLP sends as text, is there and is none."""
    found = [F.coalesce((t != "") & t.try_cast("bigint").isNull(), F.lit(False)) for t in texts]
    return reduce(lambda a, b: a | b, found)


def _unreadable_in(texts: Column) -> Column:
    return F.coalesce(F.exists(texts, lambda t: _unreadable(t)), F.lit(False))


def _id(text: Column) -> Column:
    return F.nullif(F.lower(text), F.lit(""))


def _enum(text: Column, names: list[str], prefix: str) -> Column:
    """Name of an enumeration value given as its number or its full name; the first one if unknown."""
    spelled = [F.lit(x) for i, n in enumerate(names) for x in (str(i), n, prefix + n.upper(), n)]
    return F.coalesce(F.try_element_at(F.create_map(*spelled), text), F.lit(names[0]))


def _counts(texts: Column) -> Column:
    return F.transform(texts, lambda t: t.try_cast("bigint"))


def _resource(df: DataFrame, lists: str, inner: str) -> DataFrame:
    """One row per scope: service, resource and scope text, and the scope's items."""
    per_resource = df.select(F.explode(lists).alias("r"))
    attributes = F.col("r.resource.attributes")
    service = F.get(F.filter(attributes, lambda p: p["key"] == SERVICE_NAME), 0)
    per_scope = per_resource.select(
        service["value"]["stringValue"].alias("service"),
        attributes_json(attributes, without=SERVICE_NAME).alias("resource"),
        F.explode(f"r.{inner}").alias("s"))
    return per_scope.withColumn("scope", F.to_json("s.scope"))


def _table(df: DataFrame, name: str, malformed: Column, /, **columns: Column) -> DataFrame:
    """Rows of a table, with ``_malformed`` and the record itself as ``_record``."""
    return df.select(*[
        columns.get(f.name, F.lit(None)).try_cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields
    ], malformed.alias("_malformed"), F.to_json("x").alias("_record"))


def _readable(records: DataFrame) -> DataFrame:
    return records.where(~F.col("_malformed")).drop("_malformed", "_record")


# --- Requests to rows ------------------------------------------------------------------------------


def records(requests: DataFrame, name: str) -> DataFrame:
    """The rows of table ``name`` that some requests hold, the malformed ones too.

    A record is malformed (``_malformed``) if a number or instant it needs is text that is none; ``_record`` is its JSON.
    """
    if name == "logs":
        return _log_records(requests)
    return _span_records(requests) if name == "spans" else _points(requests, name)


def record_receipt(requests: DataFrame, name: str) -> DataFrame:
    """How many records of the requests are rows of a table (``accepted``) and how many are ``malformed``."""
    return records(requests, name).agg(F.count_if(~F.col("_malformed")).alias("accepted"), F.count_if("_malformed").alias("malformed"))


def logs(requests: DataFrame) -> DataFrame:
    """Log records of logs requests. ``record_id`` is a content hash that makes orders repeatable. Malformed
    records are left out, see ``records``."""
    return _readable(_log_records(requests))


def _log_records(requests: DataFrame) -> DataFrame:
    rows = _resource(requests, "resourceLogs", "scopeLogs").select(
        "service", "resource", "scope", F.explode("s.logRecords").alias("x"))
    x = lambda name: F.col(f"x.{name}")
    severity = F.coalesce(x("severityNumber").try_cast("int"), F.lit(0))
    return _table(
        rows, "logs", _unreadable(x("timeUnixNano"), x("observedTimeUnixNano")),
        time=x("timeUnixNano"), observed_time=_nanos(x("observedTimeUnixNano")),
        service=F.col("service"), severity_number=severity, severity_text=x("severityText"),
        body=_text(x("body")), attributes=attributes_json(x("attributes")),
        trace_id=_id(x("traceId")), span_id=_id(x("spanId")),
        resource=F.col("resource"), scope=F.col("scope"),
        record_id=F.xxhash64("service", "x"))


def spans(requests: DataFrame) -> DataFrame:
    """Spans of traces requests; the duration is end minus start. Malformed ones are left out."""
    return _readable(_span_records(requests))


def _span_records(requests: DataFrame) -> DataFrame:
    rows = _resource(requests, "resourceSpans", "scopeSpans").select(
        "service", "resource", "scope", F.explode("s.spans").alias("x"))
    x = lambda name: F.col(f"x.{name}")
    start = x("startTimeUnixNano").try_cast("bigint")
    return _table(
        rows, "spans", _unreadable(x("startTimeUnixNano"), x("endTimeUnixNano")),
        trace_id=_id(x("traceId")), span_id=_id(x("spanId")), parent_span_id=_id(x("parentSpanId")),
        name=x("name"), kind=_enum(x("kind"), SPAN_KINDS, "SPAN_KIND_"), start_time=start,
        duration_ns=F.try_subtract(x("endTimeUnixNano").try_cast("bigint"), start),
        status_code=_enum(x("status.code"), STATUS_CODES, "STATUS_CODE_"),
        status_message=x("status.message"), service=F.col("service"),
        attributes=attributes_json(x("attributes")), resource=F.col("resource"), scope=F.col("scope"))


def _exemplars(list_: Column) -> Column:
    return F.transform(list_, lambda e: F.struct(
        _nanos(e["timeUnixNano"]).alias("time"),
        F.coalesce(e["asDouble"], e["asInt"].try_cast("double")).alias("value"),
        _id(e["traceId"]).alias("trace_id"), _id(e["spanId"]).alias("span_id"),
        attributes_json(e["filteredAttributes"]).alias("attributes")))


def metrics(requests: DataFrame, name: str) -> DataFrame:
    """Points of one metric table out of metrics requests. Malformed ones are left out."""
    return _readable(_points(requests, name))


def _points(requests: DataFrame, name: str) -> DataFrame:
    if name not in METRIC_TABLES:
        raise ValueError(f"unknown metric table {name!r}")
    kind = METRIC_FIELDS[name]
    per_metric = _resource(requests, "resourceMetrics", "scopeMetrics").select(
        "service", "resource", "scope", F.explode("s.metrics").alias("m"))
    rows = per_metric.where(F.col(f"m.{kind}").isNotNull()).select(
        "service", "resource", "scope", "m", F.explode(f"m.{kind}.dataPoints").alias("x"))
    x = lambda field: F.col(f"x.{field}")
    columns = {
        "point_time": x("timeUnixNano"), "metric": F.col("m.name"),
        "unit": F.coalesce("m.unit", F.lit("")), "service": F.col("service"),
        "attributes": attributes_json(x("attributes")),
        "resource": F.col("resource"), "scope": F.col("scope"),
    }
    if kind not in ("gauge", "summary"):
        columns["temporality"] = _enum(
            F.col(f"m.{kind}.aggregationTemporality"), TEMPORALITIES, "AGGREGATION_TEMPORALITY_")
    if kind == "sum":
        columns["is_monotonic"] = F.coalesce("m.sum.isMonotonic", F.lit(False))
    if kind in ("gauge", "sum"):
        columns["value"] = F.coalesce(x("asDouble"), x("asInt").try_cast("double"))
        malformed = _unreadable(x("timeUnixNano"), x("asInt"))
    else:
        columns |= {"count": x("count"), "sum": x("sum")}
        malformed = _unreadable(x("timeUnixNano"), x("count"))
    if kind != "summary":
        columns["exemplars"] = _exemplars(x("exemplars"))
    if kind == "histogram":
        columns |= {"explicit_bounds": x("explicitBounds"),
                    "bucket_counts": _counts(x("bucketCounts"))}
        malformed = malformed | _unreadable_in(x("bucketCounts"))
    if kind == "exponentialHistogram":
        columns |= {"scale": x("scale"), "zero_count": F.coalesce(x("zeroCount"), F.lit("0"))}
        for side in ("positive", "negative"):
            columns[f"{side}_offset"] = F.coalesce(x(f"{side}.offset"), F.lit(0))
            columns[f"{side}_counts"] = _counts(x(f"{side}.bucketCounts"))
            malformed = malformed | _unreadable(x("zeroCount")) | _unreadable_in(x(f"{side}.bucketCounts"))
    if kind == "summary":
        columns["quantile_values"] = x("quantileValues")
    return _table(rows, name, malformed, **columns)

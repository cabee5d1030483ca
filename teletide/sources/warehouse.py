"""Telemetry tables derived from the event, order and line tables of a warehouse.

Each function reads the Parquet tables below ``root`` and returns one telemetry table, row for row:
an event becomes a log record and a gauge point, an order a root span, a line a child span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from teletide.functions import times
from teletide.model import NS_PER_DAY, NS_PER_SECOND, SCHEMAS

QTY_BOUNDS = [10.0, 20.0, 30.0, 40.0]


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def nanos(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) * 1000


def hex_id(x: Column, width: int) -> Column:
    return F.lpad(F.lower(F.hex(x)), width, "0")


def _shard(prefix: str, x: Column, n: int) -> Column:
    return F.concat(F.lit(prefix), (x % n).cast("string"))


def _model(df: DataFrame, name: str, /, **columns: Column) -> DataFrame:
    """Select the model columns of a telemetry table, absent ones as NULL."""
    return df.select(*[
        columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields
    ])


def logs_from_events(events: DataFrame) -> DataFrame:
    """One log record per event."""
    c = F.col
    time = nanos(c("ts"))
    kind = c("event_type")
    severity = F.when(kind == "error", 17).when(kind == "purchase", 13).otherwise(9)
    method = F.element_at(F.array(F.lit("GET"), F.lit("POST"), F.lit("PUT")),
                          (c("event_id") % 3 + 1).cast("int"))
    tenant = F.when(c("event_id") % 4 != 0,
                    F.concat(F.lit(',"tenant":"'), _shard("t", c("user_id"), 6), F.lit('"'))
                    ).otherwise("")
    traced = c("event_id") % 4 != 1
    return _model(
        events, "logs",
        time=time,
        observed_time=F.when(c("event_id") % 10 != 7,
                             time + ((c("event_id") * 7919) % 600) * NS_PER_SECOND),
        service=_shard("svc-", c("user_id"), 5),
        severity_number=severity,
        severity_text=F.when(severity == 17, "ERROR").when(severity == 13, "WARN").otherwise("INFO"),
        body=F.concat(kind, F.lit(" by user "), c("user_id").cast("string")),
        attributes=F.concat(
            F.lit('{"http.method":"'), method, F.lit('","k":'),
            F.get_json_object(c("props"), "$.k"), tenant, F.lit("}")),
        trace_id=F.when(traced, hex_id(c("event_id"), 32)),
        span_id=F.when(traced, hex_id(c("event_id") * 16, 16)),
        record_id=c("event_id"),
    )


def logs(spark: SparkSession, root: str) -> DataFrame:
    return logs_from_events(table(spark, root, "events"))


def stream(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A warehouse table as a file stream."""
    schema = table(spark, root, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(root)


def document_logs(spark: SparkSession, root: str) -> DataFrame:
    """Documents as log records: whole texts as bodies, the source as the service."""
    c = F.col
    return _model(
        table(spark, root, "documents"), "logs",
        time=c("doc_id") * NS_PER_SECOND,
        service=c("source"),
        severity_number=F.lit(9),
        body=c("text"),
        attributes=F.to_json(F.struct("lang")),
        record_id=c("doc_id"),
    )


def spans_from_orders(orders: DataFrame) -> DataFrame:
    """One root span per order."""
    c = F.col
    status = F.when(c("o_orderstatus") == "F", "ERROR").when(
        c("o_orderstatus") == "O", "OK").otherwise("UNSET")
    method = F.element_at(F.array(F.lit("GET"), F.lit("POST"), F.lit("PUT")),
                          (c("o_orderkey") % 3 + 1).cast("int"))
    return _model(
        orders, "spans",
        trace_id=hex_id(c("o_orderkey"), 32),
        span_id=hex_id(c("o_orderkey") * 16, 16),
        name=F.concat(F.lit("order "), c("o_orderpriority")),
        kind=F.lit("SERVER"),
        start_time=nanos(c("o_orderdate")),
        duration_ns=F.floor(c("o_totalprice") * 100).cast("bigint") * 1000,
        status_code=status,
        service=_shard("svc-", c("o_custkey"), 5),
        attributes=F.concat(F.lit('{"http.method":"'), method, F.lit('","priority":"'),
                            c("o_orderpriority"), F.lit('"}')),
    )


def spans_from_lines(lines: DataFrame) -> DataFrame:
    """One child span per order line, below the span numbered half its own."""
    c = F.col
    base = c("l_orderkey") * 16
    number = c("l_linenumber").cast("bigint")
    return _model(
        lines, "spans",
        trace_id=hex_id(c("l_orderkey"), 32),
        span_id=hex_id(base + number, 16),
        parent_span_id=hex_id(base + times.floor_div(number, 2), 16),
        name=F.concat(F.lit("line "), c("l_linestatus")),
        kind=F.lit("INTERNAL"),
        start_time=nanos(c("l_shipdate")),
        duration_ns=F.floor(c("l_quantity")).cast("bigint") * 1_000_000,
        status_code=F.when(c("l_returnflag") == "R", "ERROR").otherwise("OK"),
        service=_shard("svc-", c("l_suppkey"), 5),
        attributes=F.concat(F.lit('{"qty":'), F.floor(c("l_quantity")).cast("string"), F.lit("}")),
    )


def spans(spark: SparkSession, root: str) -> DataFrame:
    return spans_from_orders(table(spark, root, "orders")).unionByName(
        spans_from_lines(table(spark, root, "lineitem")))


def _host_attributes() -> Column:
    host = F.col("user_id") % 7
    return F.concat(F.lit('{"host":"h'), host.cast("string"), F.lit('","rack":'),
                    times.floor_div(host, 4).cast("string"), F.lit("}"))


def gauge_from_events(events: DataFrame) -> DataFrame:
    """One gauge point per event; every fiftieth point is repeated with its value plus one."""
    c = F.col
    time = nanos(c("ts"))
    exemplar = F.struct(
        time.alias("time"), c("value").alias("value"),
        hex_id(c("event_id"), 32).alias("trace_id"), hex_id(c("event_id") * 16, 16).alias("span_id"),
        F.lit('{"sampler":"always_on"}').alias("attributes"))
    extra = F.when(c("event_id") % 50 == 0, F.array(F.lit(0.0), F.lit(1.0))).otherwise(
        F.array(F.lit(0.0)))
    return _model(
        events.select("*", F.explode(extra).alias("extra")), "metrics_gauge",
        point_time=time,
        metric=F.concat(F.lit("events."), c("event_type"), F.lit(".value")),
        unit=F.lit("1"),
        service=_shard("svc-", c("user_id"), 5),
        attributes=_host_attributes(),
        value=c("value") + c("extra"),
        exemplars=F.when((c("event_type") == "error") & (c("extra") == 0), F.array(exemplar)),
    )


def metrics_gauge(spark: SparkSession, root: str) -> DataFrame:
    return gauge_from_events(table(spark, root, "events"))


def metrics_sum(spark: SparkSession, root: str) -> DataFrame:
    """A counter per service and host that starts over every UTC day."""
    c = F.col
    time = nanos(c("ts"))
    attributes = _host_attributes()
    day = times.bucket(time, NS_PER_DAY)
    service = _shard("svc-", c("user_id"), 5)
    upto = Window.partitionBy(service, attributes, day).orderBy(time, "event_id").rowsBetween(
        Window.unboundedPreceding, 0)
    events = table(spark, root, "events")
    return _model(
        events, "metrics_sum",
        point_time=time,
        metric=F.lit("events.total"),
        unit=F.lit("1"),
        service=service,
        attributes=attributes,
        temporality=F.lit("cumulative"),
        is_monotonic=F.lit(True),
        value=F.sum(F.floor(c("value")).cast("double")).over(upto),
    )


def _by_year_and_service(lines: DataFrame) -> DataFrame:
    year = F.date_trunc("YEAR", F.col("l_shipdate"))
    return lines.groupBy(F.col("l_linestatus").alias("status"), nanos(year).alias("point_time"),
                         _shard("svc-", F.col("l_suppkey"), 5).alias("service"))


def _between(low: float | None, high: float | None) -> Column:
    """Rows of a quantity bucket, open below and closed above."""
    q = F.col("l_quantity")
    inside = F.lit(True)
    if low is not None:
        inside = inside & (q > low)
    if high is not None:
        inside = inside & (q <= high)
    return F.count_if(inside)


def metrics_histogram(spark: SparkSession, root: str) -> DataFrame:
    """Line quantities per ship year, status and service in five explicit buckets."""
    edges = [None, *QTY_BOUNDS, None]
    grouped = _by_year_and_service(table(spark, root, "lineitem")).agg(
        F.count("*").alias("count"), F.sum("l_quantity").alias("sum"),
        F.array(*[_between(lo, hi) for lo, hi in zip(edges, edges[1:])]).alias("bucket_counts"))
    return _model(
        grouped, "metrics_histogram",
        point_time=F.col("point_time"),
        metric=F.concat(F.lit("line.qty."), F.col("status")),
        unit=F.lit("{item}"), service=F.col("service"), attributes=F.lit("{}"),
        temporality=F.lit("delta"),
        count=F.col("count"), sum=F.col("sum"),
        explicit_bounds=F.array(*[F.lit(b) for b in QTY_BOUNDS]),
        bucket_counts=F.col("bucket_counts"),
    )


def metrics_exp_histogram(spark: SparkSession, root: str) -> DataFrame:
    """The same quantities in base-2 buckets: scale 0, first bucket (1/2, 1]."""
    edges = [0.5, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0]
    grouped = _by_year_and_service(table(spark, root, "lineitem")).agg(
        F.count("*").alias("count"), F.sum("l_quantity").alias("sum"),
        F.array(*[_between(lo, hi) for lo, hi in zip(edges, edges[1:])]).alias("positive_counts"))
    return _model(
        grouped, "metrics_exp_histogram",
        point_time=F.col("point_time"),
        metric=F.concat(F.lit("line.qty.exp."), F.col("status")),
        unit=F.lit("{item}"), service=F.col("service"), attributes=F.lit("{}"),
        temporality=F.lit("delta"),
        count=F.col("count"), sum=F.col("sum"), scale=F.lit(0), zero_count=F.lit(0),
        positive_offset=F.lit(-1), positive_counts=F.col("positive_counts"),
        negative_offset=F.lit(0), negative_counts=F.array(),
    )


def metrics_summary(spark: SparkSession, root: str) -> DataFrame:
    """Line prices per ship year, status and service with their 0 and 1 quantiles."""
    pair = lambda q, v: F.struct(F.lit(q).alias("quantile"), v.alias("value"))
    grouped = _by_year_and_service(table(spark, root, "lineitem")).agg(
        F.count("*").alias("count"), F.sum("l_extendedprice").alias("sum"),
        F.array(pair(0.0, F.min("l_extendedprice")), pair(1.0, F.max("l_extendedprice"))).alias("qs"))
    return _model(
        grouped, "metrics_summary",
        point_time=F.col("point_time"),
        metric=F.concat(F.lit("line.price."), F.col("status")),
        unit=F.lit("USD"), service=F.col("service"), attributes=F.lit("{}"),
        count=F.col("count"), sum=F.col("sum"), quantile_values=F.col("qs"),
    )


BUILDERS = {
    "logs": logs,
    "spans": spans,
    "metrics_gauge": metrics_gauge,
    "metrics_sum": metrics_sum,
    "metrics_histogram": metrics_histogram,
    "metrics_exp_histogram": metrics_exp_histogram,
    "metrics_summary": metrics_summary,
}


def all_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: build(spark, root) for name, build in BUILDERS.items()}

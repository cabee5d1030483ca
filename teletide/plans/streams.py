"""Registered streaming queries: each drains its source and returns what the sink holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from teletide.functions import times
from teletide.model import NS_PER_DAY, NS_PER_HOUR, NS_PER_MINUTE
from teletide.operators import maintenance
from teletide.plans.logs import DAY_12
from teletide.plans.registry import bigints, numbered, on, query
from teletide.plans.tables import NOW
from teletide.session import scratch_dir
from teletide.sources import requests, tables, warehouse
from teletide.streaming import guard, jobs

SPAN_STEP = 30 * NS_PER_DAY


def _drained(stream: DataFrame, purpose: str) -> DataFrame:
    spark = stream.sparkSession
    path = scratch_dir(spark, purpose)
    running = jobs.start(stream, f"{path}/rows", f"{path}/checkpoint")
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def _log_stream(spark: SparkSession, root: str) -> DataFrame:
    return warehouse.logs_from_events(warehouse.stream(spark, root, "events"))


def _span_stream(spark: SparkSession, root: str) -> DataFrame:
    return warehouse.spans_from_orders(warehouse.stream(spark, root, "orders")).unionByName(
        warehouse.spans_from_lines(warehouse.stream(spark, root, "lineitem")))


def _batch_files(spark: SparkSession) -> int:
    """Files of a batch: some for every core, as a batch of a few leaves the others idle however many files wait."""
    return 4 * spark.sparkContext.defaultParallelism


query("tail_poll", f"""
    SELECT record_id, time, observed_time, service, body FROM logs
    WHERE observed_time > {DAY_12} AND service = 'svc-1'""")(
    on("logs", lambda df: jobs.tail_poll(df, DAY_12, service="svc-1").select(
        "record_id", "time", "observed_time", "service", "body")))


@query("tail_stream", """
    SELECT record_id, time, observed_time, service, body FROM logs WHERE observed_time IS NOT NULL""")
def tail_stream(spark: SparkSession, root: str) -> DataFrame:
    tail = jobs.tail_stream(_log_stream(spark, root)).select(
        "record_id", "time", "observed_time", "service", "body")
    return _drained(tail, "tail")


@query("stream_reject", "SELECT metric, service, attributes, point_time, min(value) AS value "
                        "FROM metrics_gauge GROUP BY ALL")
def stream_reject(spark: SparkSession, root: str) -> DataFrame:
    points = warehouse.gauge_from_events(warehouse.stream(spark, root, "events"))
    kept = guard.reject_stream(points, ["value"], arrival=["value"], recent=1 << 24, shards=8)
    return _drained(kept, "reject")


# A window is closed once the newest instant, to the millisecond, is a delay past its end.
def _closed(view: str, time: str, step: int, delay: int, columns: str, keys: str = "service") -> str:
    return f"""
    WITH m AS (SELECT max({time}) // 1000000 * 1000000 - {delay} AS mark FROM {view})
    SELECT {time} - {time} % {step} AS bucket, {keys}, {columns}
    FROM {view} WHERE {time} - {time} % {step} + {step} <= (SELECT mark FROM m) GROUP BY ALL"""


@query("stream_log_volume", _closed("logs", "time", NS_PER_HOUR, 10 * NS_PER_MINUTE, "count(*) AS count"))
def stream_log_volume(spark: SparkSession, root: str) -> DataFrame:
    return _drained(jobs.log_volume(_log_stream(spark, root), "1 hour", "10 minutes"), "volume")


@query("stream_log_sliding", f"""
    WITH m AS (SELECT max(time) // 1000000 * 1000000 - {10 * NS_PER_MINUTE} AS mark FROM logs)
    SELECT bucket, service, count(*) AS count
    FROM (SELECT service, time - time % {NS_PER_HOUR} - unnest([0, 1, 2]) * {NS_PER_HOUR} AS bucket FROM logs)
    WHERE bucket + {3 * NS_PER_HOUR} <= (SELECT mark FROM m) GROUP BY ALL""")
def stream_log_sliding(spark: SparkSession, root: str) -> DataFrame:
    counts = jobs.log_volume(_log_stream(spark, root), "3 hours", "10 minutes", slide="1 hour")
    return _drained(counts, "sliding")


@query("stream_span_red", _closed(
    "spans", "start_time", SPAN_STEP, NS_PER_DAY,
    "count(*) AS calls, count(*) FILTER (status_code = 'ERROR') AS errors"))
def stream_span_red(spark: SparkSession, root: str) -> DataFrame:
    red = jobs.span_red(_span_stream(spark, root), "30 days", "1 day")
    return _drained(red, "red").select("bucket", "service", "calls", "errors")


@query("stream_ingest", f"""
    SELECT time - time % {NS_PER_DAY} AS day, service, severity_number, count(*) AS rows,
           CAST(sum(time % 1000003) AS BIGINT) AS checksum, count(DISTINCT attributes) AS attribute_sets
    FROM logs GROUP BY ALL""")
def stream_ingest(spark: SparkSession, root: str) -> DataFrame:
    """Requests arrive as files and end up in a day-partitioned table."""
    path = scratch_dir(spark, "ingest")
    requests.write(requests.from_logs(warehouse.logs(spark, root)), f"{path}/inbox")
    jobs.ingest_logs(spark, f"{path}/inbox", f"{path}/table", f"{path}/checkpoint",
                     files_per_trigger=_batch_files(spark)).awaitTermination()
    stored = tables.read_table(spark, "logs", f"{path}/table")
    return bigints(stored.groupBy(times.bucket(F.col("time"), NS_PER_DAY).alias("day"), "service",
                                  "severity_number").agg(
        F.count("*").alias("rows"), F.sum(F.col("time") % 1000003).alias("checksum"),
        F.countDistinct("attributes").alias("attribute_sets")))


@query("stream_dead_letters", """
    SELECT count(*) AS stored, count(*) AS accepted, count(*) FILTER (severity_number >= 17) AS malformed,
           count(*) FILTER (severity_number = 13) AS broken_lines,
           count(*) FILTER (severity_number = 13 OR severity_number >= 17) AS letters FROM logs""")
def stream_dead_letters(spark: SparkSession, root: str) -> DataFrame:
    """The accounts of a stream with a malformed record for each error and a broken line for each warning."""
    path, logs = scratch_dir(spark, "letters"), warehouse.logs(spark, root)
    requests.write(requests.from_logs(logs), f"{path}/inbox")
    bad = '{"resourceLogs":[{"scopeLogs":[{"logRecords":[{"timeUnixNano":"%d ns"}]}]}]}'
    requests.write(logs.where("severity_number >= 17").select(F.format_string(bad, "record_id")), f"{path}/inbox")
    requests.write(logs.where("severity_number = 13").select(F.format_string('{"resourceLogs": [%d', "record_id")), f"{path}/inbox")
    jobs.ingest_logs(spark, f"{path}/inbox", f"{path}/table", f"{path}/checkpoint",
                     files_per_trigger=_batch_files(spark)).awaitTermination()
    stored = tables.read_table(spark, "logs", f"{path}/table").agg(F.count("*").alias("stored"))
    counts = jobs.receipts(spark, f"{path}/table").agg(*[F.sum(c).alias(c) for c in ("accepted", "malformed", "broken_lines")])
    letters = jobs.dead_letters(spark, f"{path}/table").agg(F.count("*").alias("letters"))
    parts = stored.unionByName(counts, allowMissingColumns=True).unionByName(letters, allowMissingColumns=True)
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])


@query("ingest_append_compact", f"""
    SELECT time - time % {NS_PER_DAY} AS day, count(*) AS rows,
           CAST(sum(time % 1000003) AS BIGINT) AS checksum
    FROM logs WHERE time >= {NOW - 7 * NS_PER_DAY} GROUP BY ALL""")
def ingest_append_compact(spark: SparkSession, root: str) -> DataFrame:
    """One table fed by a stream and by a batch writer, then compacted and cut to a week."""
    path, logs = scratch_dir(spark, "shared"), warehouse.logs(spark, root)
    streamed = F.col("severity_number") < 13
    requests.write(requests.from_logs(logs.where(streamed)), f"{path}/inbox")
    jobs.ingest_logs(spark, f"{path}/inbox", f"{path}/table", f"{path}/checkpoint").awaitTermination()
    tables.write_table(logs.where(~streamed | streamed.isNull()), "logs", f"{path}/table")
    maintenance.compact(spark, "logs", f"{path}/table")
    maintenance.enforce_retention(spark, f"{path}/table", NOW, days=7)
    stored = tables.read_table(spark, "logs", f"{path}/table")
    return stored.groupBy(times.bucket(F.col("time"), NS_PER_DAY).alias("day")).agg(
        F.count("*").alias("rows"), F.sum(F.col("time") % 1000003).alias("checksum"))


@query("tail_pages", f"""
    SELECT record_id, row_number() OVER (ORDER BY observed_time, time, record_id) AS rn FROM logs
    WHERE observed_time > {DAY_12} QUALIFY rn <= 600""")
def tail_pages(spark: SparkSession, root: str) -> DataFrame:
    """Two polls of a follow loop, the second from the last row of the first."""
    logs = warehouse.logs(spark, root)
    order = ["observed_time", "time", "record_id"]
    first = jobs.tail_after(logs, (DAY_12, None, None), limit=300)
    last = first.select(F.max(F.struct(*order)).alias("c")).first()["c"]
    pages = first.unionByName(jobs.tail_after(logs, tuple(last), limit=300)) if last else first
    return numbered(pages, *[F.col(c) for c in order]).select("record_id", "rn")


@query("tail_order", f"""
    SELECT record_id, row_number() OVER (ORDER BY observed_time, time, record_id) AS rn FROM logs
    WHERE observed_time > {DAY_12} QUALIFY rn <= 500""")
def tail_order(spark: SparkSession, root: str) -> DataFrame:
    """One poll of a follow loop: the next rows by arrival."""
    rows = jobs.tail_poll(warehouse.logs(spark, root), DAY_12, limit=500)
    return numbered(rows, F.col("observed_time"), F.col("time"), F.col("record_id")).select(
        "record_id", "rn")

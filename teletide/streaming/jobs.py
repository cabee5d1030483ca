"""Structured Streaming jobs: the log tail, windowed counts and continuous ingest."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from teletide.functions import times
from teletide.operators.logs import OBSERVED_TIME, LogQuery, filter_logs, query_logs
from teletide.sources import files, otlp
from teletide.sources.tables import publish_spans, write_table


def start(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
          partition_by: list[str] | None = None) -> StreamingQuery:
    """Write a stream to a Parquet folder of its own, each row exactly once. For tables that others
    write to or maintain, use ``into_table``.

    The default trigger drains what is there and stops; pass e.g. ``{"processingTime": "10 seconds"}``
    to keep running.
    """
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"availableNow": True}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.format("parquet").start(path)


# --- Arrival-ordered tail --------------------------------------------------------------------------


def tail_poll(logs: DataFrame, watermark: int, limit: int = 0, **filters) -> DataFrame:
    """Rows that arrived after ``watermark``, in arrival order. Feed back the largest arrival seen;
    start with 0. Rows without an arrival time are left out of the very first poll too. With a
    ``limit``, rows of one arrival instant may be parted: go on with ``tail_after`` instead."""
    return query_logs(tail_stream(logs), LogQuery(
        observed_after=watermark, order_by=OBSERVED_TIME, limit=limit, **filters))


def tail_after(logs: DataFrame, cursor: tuple[int, int | None, int | None] | None, limit: int = 0,
               **filters) -> DataFrame:
    """The next rows by (arrival, time, record_id) after the row that ``cursor`` names by these three
    values; None starts. Feed back those of the last row; ties of one instant go on in the next poll.
    As in ``query_logs`` a missing time or id comes after all others of its instant."""
    arrival, order = F.col("observed_time"), ["time", "record_id"]
    rows = tail_stream(logs)
    if cursor is not None:
        later = F.lit(False)
        for column, value in reversed([*zip(order, cursor[1:], strict=True)]):
            c = F.col(column)
            beyond = F.lit(False) if value is None else c.isNull() | (c > value)
            later = beyond | (c.eqNullSafe(F.lit(value)) & later)
        rows = rows.where((arrival > cursor[0]) | ((arrival == cursor[0]) & later))
    rows = filter_logs(rows, LogQuery(**filters)).orderBy(
        arrival, *[F.col(c).asc_nulls_last() for c in order])
    return rows.limit(limit) if limit else rows


def tail_stream(logs: DataFrame) -> DataFrame:
    """The streaming tail: the source delivers each row once, whatever its event time; rows without
    an arrival time are skipped as in the polling form."""
    return logs.where(F.col("observed_time").isNotNull())


# --- Windowed counts -------------------------------------------------------------------------------


def _windowed(df: DataFrame, time: str, step: str, delay: str, slide: str | None):
    stamped = df.withColumn("_ts", times.to_timestamp(F.col(time))).withWatermark("_ts", delay)
    return stamped, F.window("_ts", step, slide).alias("w")


def _bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("bucket", F.unix_micros(F.col("w.start")) * 1000).drop("w")


def log_volume(logs: DataFrame, step: str, delay: str, slide: str | None = None) -> DataFrame:
    """Lines per window and service, tumbling or, with ``slide``, overlapping. A window is emitted
    once the newest event time is ``delay`` past its end."""
    rows, window = _windowed(logs, "time", step, delay, slide)
    counts = rows.groupBy(window, F.coalesce("service", F.lit("")).alias("service")).agg(
        F.count("*").alias("count"))
    return _bucket(counts).select("bucket", "service", "count")


def span_red(spans: DataFrame, step: str, delay: str, accuracy: int = 1000) -> DataFrame:
    """Calls, errors and sketched latencies per window and service."""
    rows, window = _windowed(spans, "start_time", step, delay, None)
    red = rows.groupBy(window, F.coalesce("service", F.lit("")).alias("service")).agg(
        F.count("*").alias("calls"),
        F.count_if(F.col("status_code") == "ERROR").alias("errors"),
        F.percentile_approx("duration_ns", [0.5, 0.95, 0.99], accuracy).alias("ps"))
    return _bucket(red).select(
        "bucket", "service", "calls", "errors",
        *[F.get("ps", i).cast("double").alias(n) for i, n in enumerate(["p50", "p95", "p99"])])


# --- Continuous ingest -----------------------------------------------------------------------------


BROKEN_LINE = "_broken_line"


def ingest_stream(spark: SparkSession, signal: str, inbox: str, files_per_trigger: int = 1000) -> DataFrame:
    """OTLP request files appearing in ``inbox``, as a stream of requests; a line that is none is in ``_broken_line``."""
    return spark.readStream.schema(f"{otlp.REQUESTS[signal]}, {BROKEN_LINE} string").option(
        "columnNameOfCorruptRecord", BROKEN_LINE).option("maxFilesPerTrigger", files_per_trigger).json(inbox)


def append_batch(batch: DataFrame, name: str, table: str, staging: str, done: str) -> None:
    """Append one micro-batch to a table folder, once however often it is tried.

    The rows are written to ``staging`` as ``write_table`` writes them, the finished files are moved into
    the table, and the file ``done`` records the end. A repeated attempt goes on where the last one stopped.
    """
    spark = batch.sparkSession
    if files.exists(spark, done):
        return
    if not files.finished(spark, staging):
        write_table(batch, name, staging, mode="overwrite", trace_index=False)
    (publish_spans if name == "spans" else files.publish)(spark, staging, table)
    files.mark(spark, done)
    files.delete(spark, staging)


def into_table(rows: DataFrame, name: str, table: str, checkpoint: str,
               trigger: dict | None = None) -> StreamingQuery:
    """Append a stream of rows to a table folder that batch writers, compaction and retention may share."""
    key = hashlib.sha1(checkpoint.encode()).hexdigest()

    def append(batch: DataFrame, number: int) -> None:
        append_batch(batch, name, table, f"{table}/_staging/{key}-{number}", f"{checkpoint}/appended/{number}")
    return rows.writeStream.option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"availableNow": True})).foreachBatch(append).start()


def ingest(spark: SparkSession, signal: str, name: str, inbox: str, table: str, checkpoint: str,
           trigger: dict | None = None, files_per_trigger: int = 1000) -> StreamingQuery:
    """Flatten arriving requests into the day partitions of a table folder, and account for every record.

    What cannot be stored goes to the folder ``_dead_letters`` of the table, lines that are no request as they came and
    malformed records as JSON. ``_receipts`` has a row for each batch with how many records were stored, how many were
    malformed, and how many lines were broken. Both are written once for each batch, however often it is tried.
    """
    key = hashlib.sha1(checkpoint.encode()).hexdigest()

    def store(requests: DataFrame, number: int) -> None:
        found = otlp.records(requests.where(F.col(BROKEN_LINE).isNull()), name)
        # Read five times below, so parsed once; the text of a record is wanted of the malformed ones only.
        found = found.withColumn("_record", F.when(F.col("_malformed"), F.col("_record"))).persist()
        try:
            store_parsed(requests, found, number)
        finally:
            found.unpersist()

    def store_parsed(requests: DataFrame, found: DataFrame, number: int) -> None:
        append_batch(found.where(~F.col("_malformed")).drop("_malformed", "_record"), name, table,
                     f"{table}/_staging/{key}-{number}", f"{checkpoint}/appended/{number}")
        broken = requests.where(F.col(BROKEN_LINE).isNotNull() & (F.trim(BROKEN_LINE) != ""))
        letters = broken.select(F.lit("line").alias("kind"), F.col(BROKEN_LINE).alias("text")).unionByName(
            found.where("_malformed").select(F.lit("record").alias("kind"), F.col("_record").alias("text")))
        letters.write.mode("overwrite").parquet(f"{table}/_dead_letters/{key}-{number}")
        counts = found.agg(F.count_if(~F.col("_malformed")).alias("accepted"), F.count_if("_malformed").alias("malformed"))
        lines = broken.agg(F.count("*").alias("broken_lines"))
        both = counts.unionByName(lines, allowMissingColumns=True).agg(
            F.lit(number).cast("bigint").alias("batch"), *[F.max(c).alias(c) for c in ("accepted", "malformed", "broken_lines")])
        both.coalesce(1).write.mode("overwrite").parquet(f"{table}/_receipts/{key}-{number}")
    return ingest_stream(spark, signal, inbox, files_per_trigger).writeStream.option(
        "checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).foreachBatch(store).start()


def receipts(spark: SparkSession, table: str) -> DataFrame:
    """batch, accepted, malformed and broken_lines of every batch that ``ingest`` stored in a table."""
    return _beside(spark, table, "_receipts", "batch long, accepted long, malformed long, broken_lines long")


def dead_letters(spark: SparkSession, table: str) -> DataFrame:
    """kind (``line`` or ``record``) and text of everything that could not be stored."""
    return _beside(spark, table, "_dead_letters", "kind string, text string")


def _beside(spark: SparkSession, table: str, folder: str, schema: str) -> DataFrame:
    parts = files.children(spark, f"{table}/{folder}")
    return spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)


def ingest_logs(spark: SparkSession, inbox: str, table: str, checkpoint: str, trigger: dict | None = None,
                files_per_trigger: int = 1000) -> StreamingQuery:
    return ingest(spark, "logs", "logs", inbox, table, checkpoint, trigger, files_per_trigger)


def ingest_spans(spark: SparkSession, inbox: str, table: str, checkpoint: str, trigger: dict | None = None,
                 files_per_trigger: int = 1000) -> StreamingQuery:
    return ingest(spark, "traces", "spans", inbox, table, checkpoint, trigger, files_per_trigger)


def ingest_metrics(spark: SparkSession, name: str, inbox: str, table: str, checkpoint: str, trigger: dict | None = None,
                   files_per_trigger: int = 1000) -> StreamingQuery:
    return ingest(spark, "metrics", name, inbox, table, checkpoint, trigger, files_per_trigger)

"""Telemetry tables as Parquet folders partitioned by UTC day, and as SQL views."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from teletide.functions import times
from teletide.functions.attrs import SERVICE_KEYS, columns, json_text, promoted_keys, series_key
from teletide.model import METRIC_TABLES, RESERVED, SCHEMAS, time_column
from teletide.sources import files as folders, traceindex

CODECS = ("none", "lz4", "zstd", "snappy")


def register_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Make telemetry tables available to SQL under their own names."""
    for name, df in tables.items():
        time_column(name)  # rejects unknown names
        df.createOrReplaceTempView(name)


def table(spark: SparkSession, name: str) -> DataFrame:
    """A registered telemetry table."""
    time_column(name)
    return spark.table(name)


def promote(df: DataFrame, keys: list[str]) -> DataFrame:
    """Add a column per attribute key. Names of the model's columns and the service spellings are left
    out; as column names ignore case, so does this, and two keys that differ in case only are an error."""
    taken = {c.lower() for c in [*RESERVED, *SERVICE_KEYS, *df.columns]}
    kept = [k for k in dict.fromkeys(keys) if k.lower() not in taken]
    if len({k.lower() for k in kept}) < len(kept):
        raise ValueError("promoted keys differ in case only")
    return df.withColumns({k: json_text(F.col("attributes"), k) for k in kept})


def with_day(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("day", times.to_day(F.col(time_column(name))))


def write_table(df: DataFrame, name: str, path: str, codec: str = "zstd", level: int | None = None,
                promote_keys: list[str] | None = None, with_series: bool = False,
                files: int | None = None, mode: str = "append", trace_index: bool = True) -> None:
    """Append rows to a table folder, one partition per UTC day.

    Rows are ranged by day and time first, so that files cover narrow time spans (which prunes row
    groups later), a busy day is spread over several tasks and a quiet one does not leave a file per
    task. ``files`` sets the number of ranges, by default the session's shuffle partitions with small
    ones merged. ``with_series`` stores the identity of metric series in a column of its own.

    Spans are finished in a staging folder, entered in the table's trace index and then moved in, so that
    no reader sees a span that the index does not know. Without ``trace_index`` the table has none: a table
    that has one needs it on every write.
    """
    if codec not in CODECS:
        raise ValueError(f"unknown codec {codec!r}")
    if name != "spans" or not trace_index:
        _write_days(df, name, path, codec, level, promote_keys, with_series, files, mode)
        return
    spark = df.sparkSession
    staging = f"{path}/_staging/{uuid.uuid4().hex}"
    if mode == "append":
        _write_days(df, name, staging, codec, level, promote_keys, with_series, files, mode)
        publish_spans(spark, staging, path)
        folders.delete(spark, staging)
    else:
        _write_days(df, name, path, codec, level, promote_keys, with_series, files, mode)
        traceindex.rebuild(spark, path)


def publish_spans(spark: SparkSession, staging: str, path: str) -> None:
    """Enter the spans of a finished staging folder in the trace index of a table, then move them in.

    Safe to repeat: entries that are there twice mean nothing, and only files not moved yet are left.
    """
    if any("/day=" in child for child in folders.children(spark, staging)):  # else there was no row
        if folders.days(spark, path) and not traceindex.exists(spark, path):
            traceindex.rebuild(spark, path)  # spans stored before the table had an index
        traceindex.add(spark.read.parquet(staging).withColumn("day", F.col("day").cast("date")), path)
        folders.publish(spark, staging, path)


def _write_days(df: DataFrame, name: str, path: str, codec: str, level: int | None, promote_keys: list[str] | None,
                with_series: bool, files: int | None, mode: str) -> None:
    rows = promote(with_day(df, name), promote_keys or [])
    if with_series and name in METRIC_TABLES:
        rows = rows.withColumn(
            "series", series_key(F.col("service"), F.col("metric"), F.col("attributes")))
    time = time_column(name)
    tie = F.xxhash64(*columns(rows.columns))  # spreads the rows of one instant
    ranges = [files, "day", time, tie] if files else ["day", time, tie]
    writer = rows.repartitionByRange(*ranges).sortWithinPartitions("day", time).write
    if codec == "zstd" and level is not None:
        writer = writer.option("parquet.compression.codec.zstd.level", str(level))
    if name == "spans":
        writer = traceindex.bloom_options(writer)
    writer.mode(mode).partitionBy("day").option("compression", codec).parquet(path)


def read_table(spark: SparkSession, name: str, path: str,
               promoted: list[str] | None = None) -> DataFrame:
    """A table folder with its columns united by name over all files.

    ``promoted`` lists the keys that count as promoted now; columns of other keys are hidden, so that
    predicates on them go to the attributes. By default every promoted column is used. Rows written
    before a key was promoted have NULL there.
    """
    time_column(name)
    df = spark.read.option("mergeSchema", "true").parquet(path)
    missing = [f for f in SCHEMAS[name].fields if f.name not in df.columns]
    df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df
    if promoted is not None:
        df = df.drop(*(promoted_keys(df) - set(promoted)))
    return df


def export_range(df: DataFrame, name: str, start: int = 0, end: int = 0) -> DataFrame:
    """Rows of a table in [start, end) by time; 0, 0 takes everything."""
    time = time_column(name)
    return times.in_range(df, time, start, end).orderBy(time, F.xxhash64(*columns(df.columns)))


def write_export(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write exported rows; the files are in time order as a whole."""
    rows.write.format(fmt).mode("errorifexists").save(path)

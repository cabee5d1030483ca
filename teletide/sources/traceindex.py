"""Which days hold spans of which trace: a small table beside a stored spans table.

A trace id says nothing about time, so reading one trace would open the files of every day. The index has a row
for each trace and day, sorted by trace and with Bloom filters, in the folder ``_trace_index`` of the table, which
scans of the table pass over. Its entries are written before the spans they tell of can be seen, so the index may name
a day too many, after retention or a broken-off write, and never one too few. Repeated entries mean nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from teletide.sources import files

FOLDER = "_trace_index"
SCHEMA = "trace_id string, day date"
# Entries in one file at most.
ROWS_OF_A_FILE = 10_000_000


def bloom_options(writer, column: str = "trace_id"):
    """Parquet Bloom filters on a column, by which a scan for single values skips row groups; their size follows the
    number of values."""
    return writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")


def _append(pairs: DataFrame, path: str) -> None:
    part = f"{path}/{FOLDER}/{uuid.uuid4().hex}"
    ordered = pairs.where("trace_id is not null").distinct().repartitionByRange("trace_id").sortWithinPartitions("trace_id")
    bloom_options(ordered.write).option("maxRecordsPerFile", ROWS_OF_A_FILE).parquet(part)


def add(spans: DataFrame, path: str) -> None:
    """Enter spans, given with their ``day``, that are about to be added to the table folder ``path``."""
    _append(spans.select("trace_id", "day"), path)


def exists(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, f"{path}/{FOLDER}")


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """trace_id and day of a table folder; None if it has no index. List the table's own files first."""
    parts = files.children(spark, f"{path}/{FOLDER}")
    if not parts:
        return None
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet").parquet(f"{path}/{FOLDER}")


def rebuild(spark: SparkSession, path: str) -> None:
    """Make the index of a table that was written without one. Nothing may be added to the table meanwhile."""
    before = files.children(spark, f"{path}/{FOLDER}")
    stored = spark.read.parquet(path)
    # A broken-off build must not pass for an index, so its folder gets its name when it is finished.
    staging = f"{path}/_trace_build"
    files.delete(spark, staging)
    _append(stored.select("trace_id", F.col("day").cast("date").alias("day")), staging)
    files.move(spark, files.children(spark, f"{staging}/{FOLDER}"), f"{path}/{FOLDER}")
    for part in before:
        files.delete(spark, part)
    files.delete(spark, staging)


def compact(spark: SparkSession, path: str, most_parts: int = 1) -> int:
    """Merge the parts of the index into one when there are more than ``most_parts``; returns how many were merged.

    The old parts are deleted after the new one is finished, so a broken-off run leaves repeated entries at most.
    """
    parts = files.children(spark, f"{path}/{FOLDER}")
    if len(parts) <= most_parts:
        return 0
    _append(spark.read.schema(SCHEMA).parquet(*parts), path)
    for part in parts:
        files.delete(spark, part)
    return len(parts)

"""Jobs on table folders: compaction, retention, statistics and snapshots."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from teletide.functions import times
from teletide.functions.attrs import columns
from teletide.model import NS_PER_DAY, time_column
from teletide.sources import files, traceindex

# A file is sorted in memory by the task that writes it, where spans take some twenty times their bytes in the file.
TARGET_FILE_BYTES = 64 << 20
_DAY_IN_PATH = r"day=(\d{4}-\d{2}-\d{2})"


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and day of every data file of a table folder; contents are not read. The day is NULL
    for rows without a time."""
    stored = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet").load(path)
    return stored.select(
        "path", F.col("length").alias("bytes"),
        F.regexp_extract("path", _DAY_IN_PATH, 1).try_cast("date").alias("day"))


def compact(spark: SparkSession, name: str, path: str, codec: str = "zstd",
            target_bytes: int = TARGET_FILE_BYTES, min_files: int = 2) -> dict[str, int]:
    """Merge the files below half of ``target_bytes`` of every day that has ``min_files`` or more of them
    and would have fewer afterwards; a settled day is left alone.

    Files written under different promoted keys are united by column name; nothing is back-filled.
    A day that fits one file is written by a task of its own, a larger one is ranged by time and a row hash over as
    many tasks as its bytes call for. The new files are finished in a staging folder, the list of merged
    files is stored beside it, and only then are the new files moved in and exactly the listed ones deleted;
    files that another writer adds meanwhile stay. What a broken-off run left is finished first, so run one
    compaction of a table at a time. A reader may see rows twice between the move and the deletion, never too few.
    Spans stay on their days, so their trace index remains as it is, but for its parts being merged too.
    """
    if name == "spans":
        traceindex.compact(spark, path)
    for left in files.children(spark, f"{path}/_compaction"):
        _swap(spark, left, path)
    small = data_files(spark, path).where(F.col("bytes") * 2 < target_bytes)
    of_day = Window.partitionBy("day")  # a row per small file
    chosen = small.select("path", "day", F.count("*").over(of_day).alias("files"), F.ceil(
        F.sum("bytes").over(of_day) / target_bytes).alias("outputs")).where(
        (F.col("files") >= max(min_files, 2)) & (F.col("outputs") < F.col("files")))
    merged = chosen.collect()  # Spark lists the files of a scan on the driver in any case
    if not merged:
        return {"files_merged": 0, "files_created": 0}
    work = f"{path}/_compaction/{uuid.uuid4().hex}"
    time, parts = time_column(name), []
    single = [r for r in merged if r["outputs"] == 1]
    for part, rows in (("single", single), ("ranged", [r for r in merged if r["outputs"] > 1])):
        if not rows:
            continue
        df = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*[r["path"] for r in rows])
        tasks = sum({r["day"]: r["outputs"] for r in rows}.values())
        df = _by_day(df, [r["day"] for r in rows]) if rows is single else df.repartitionByRange(
            tasks, "day", time, F.xxhash64(*columns(df.columns)))
        writer = df.sortWithinPartitions("day", time).write.option("compression", codec).partitionBy("day")
        (traceindex.bloom_options(writer) if name == "spans" else writer).parquet(f"{work}/{part}")
        parts.append(part)
    # The stored list is the point from which on a repeated run finishes the work instead of dropping it.
    spark.createDataFrame([(r["path"],) for r in merged], "path string").write.parquet(f"{work}/merged")
    return {"files_merged": len(merged), "files_created": _swap(spark, work, path)}


def _by_day(df: DataFrame, days: list) -> DataFrame:
    """Each of the days, one of which may be None, in a task of its own; a hash would put several into one."""
    task_of = df.sparkSession.createDataFrame([(d, i) for i, d in enumerate(dict.fromkeys(days))], "_day date, _task int")
    dealt = df.join(F.broadcast(task_of), F.col("day").cast("date").eqNullSafe(F.col("_day")))
    return dealt.repartitionById(len(set(days)), "_task").drop("_day", "_task")


def _swap(spark: SparkSession, work: str, path: str) -> int:
    """Move the files of a compaction in and delete those it merged; one without its list is dropped."""
    created = 0
    if files.finished(spark, f"{work}/merged"):
        for part in ("single", "ranged"):
            created += files.publish(spark, f"{work}/{part}", path)
        files.delete_all(spark, [r["path"] for r in spark.read.parquet(f"{work}/merged").collect()])
    files.delete(spark, work)
    return created


def retain_days(df: DataFrame, name: str, days: int, now: int) -> DataFrame:
    """Rows not older than ``days`` whole days before ``now``."""
    return times.in_range(df, time_column(name), now - days * NS_PER_DAY)


def days_to_drop_by_bytes(stored: DataFrame, max_bytes: int) -> DataFrame:
    """Days that exceed a byte budget when days are kept newest first: ``day``, ``bytes``. Rows without
    a day stay."""
    per_day = stored.where("day is not null").groupBy("day").agg(F.sum("bytes").alias("bytes"))
    newest_first = Window.orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, 0)
    running = per_day.withColumn("kept", F.sum("bytes").over(newest_first))  # a row per day
    return running.where(F.col("kept") > max_bytes).select("day", "bytes")


def drop_days(spark: SparkSession, path: str, days: DataFrame) -> dict[str, int]:
    """Delete the day partitions listed in ``days`` (columns ``day`` and ``bytes``)."""
    doomed = days.collect()  # one row per day partition
    files.delete_all(spark, [f"{path}/day={r['day'].isoformat()}" for r in doomed])
    return {"days_dropped": len(doomed), "bytes_freed": sum(r["bytes"] for r in doomed)}


def enforce_retention(spark: SparkSession, path: str, now: int, days: int = 0,
                      max_bytes: int = 0) -> dict[str, int]:
    """Drop whole day partitions past the age limit, then the oldest beyond the byte budget."""
    report = {"days_dropped": 0, "bytes_freed": 0}
    if days > 0:
        cutoff = times.to_day(F.lit(now - days * NS_PER_DAY))
        old = data_files(spark, path).where(F.col("day") < cutoff).groupBy("day").agg(
            F.sum("bytes").alias("bytes"))
        report = drop_days(spark, path, old)
    if max_bytes > 0:
        over = drop_days(spark, path, days_to_drop_by_bytes(data_files(spark, path), max_bytes))
        report = {k: report[k] + over[k] for k in report}
    return report


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and covered time of every table."""
    def stats(name: str, df: DataFrame) -> DataFrame:
        time = time_column(name)
        return df.agg(F.count("*").alias("rows"), F.min(time).alias("min_time"),
                      F.max(time).alias("max_time")).select(F.lit(name).alias("table"), "*")
    return reduce(DataFrame.unionByName, [stats(n, df) for n, df in tables.items()])


def segments(df: DataFrame, name: str) -> DataFrame:
    """Each data file of a table read from disk, with its rows and covered time."""
    time = time_column(name)
    return df.select(F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_size").alias("bytes"), time).groupBy("path", "bytes").agg(
        F.min(time).alias("min_time"), F.max(time).alias("max_time"), F.count("*").alias("rows"))


def snapshot(spark: SparkSession, path: str, target: str) -> dict[str, object]:
    """Copy a table folder as one job that reads a fixed file listing; a trace index is made anew."""
    rows = spark.read.option("mergeSchema", "true").parquet(path)
    writer = rows.write.mode("errorifexists")
    (writer.partitionBy("day") if "day" in rows.columns else writer).parquet(target)
    if traceindex.exists(spark, path):
        traceindex.rebuild(spark, target)
    return {"dir": target, "segments": data_files(spark, target).count()}

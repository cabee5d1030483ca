"""Adding finished files to a table folder, so that a repeated or broken-off attempt neither loses nor doubles rows."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Requests to the file system under way at once.
REQUESTS = 16


def _path(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return made, made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    made, fs = _path(spark, path)
    return fs.exists(made)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; one that is gone already is no error."""
    made, fs = _path(spark, path)
    fs.delete(made, True)


def mark(spark: SparkSession, path: str) -> None:
    """Leave an empty file."""
    made, fs = _path(spark, path)
    fs.create(made, True).close()


def children(spark: SparkSession, path: str) -> list[str]:
    """The folders and files of a folder, none if it does not exist."""
    made, fs = _path(spark, path)
    return [s.getPath().toString() for s in fs.listStatus(made)] if fs.exists(made) else []


def days(spark: SparkSession, table: str) -> list[str]:
    """The day folders of a table folder."""
    return [c for c in children(spark, table) if c.rsplit("/", 1)[1].startswith("day=")]


def move(spark: SparkSession, paths: list[str], folder: str) -> None:
    """Move files or folders into a folder."""
    target, fs = _path(spark, folder)
    fs.mkdirs(target)
    for path in paths:
        if not fs.rename(_path(spark, path)[0], target):
            raise OSError(f"cannot move {path} to {folder}")


def finished(spark: SparkSession, staging: str) -> bool:
    """Whether the job that wrote a staging folder came to its end."""
    return exists(spark, f"{staging}/_SUCCESS")


def delete_all(spark: SparkSession, paths: list[str]) -> None:
    """Delete files or folders, several at a time."""
    with ThreadPoolExecutor(REQUESTS) as pool:
        list(pool.map(lambda p: delete(spark, p), paths))


def publish(spark: SparkSession, staging: str, table: str) -> int:
    """Move the files of a finished staging folder into the day folders of ``table``; returns their number.

    The names are unique, so files of other writers stay. After a broken-off attempt the files left are moved.
    Several days are under way at once.
    """
    def move_day(day: str) -> int:
        found = [f for f in children(spark, day) if f.endswith(".parquet")]
        move(spark, found, f"{table}/{day.rsplit('/', 1)[1]}")
        return len(found)

    with ThreadPoolExecutor(REQUESTS) as pool:
        return sum(pool.map(move_day, days(spark, staging)))

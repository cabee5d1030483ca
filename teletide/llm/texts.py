"""Byte-level text helpers and the batch plumbing that the Python operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# Text handed to a function at once. A longer single text comes alone.
SLICE_BYTES = 2 << 20
# Rows that one Arrow batch holds at most, so that a batch of long texts stays small.
BATCH_ROWS = 256

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
# Lower-cases A-Z and turns every ASCII byte that is neither letter nor digit into a space.
# Bytes above 0x7F stay, so words are those of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing.
ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def alnum_words(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters, digits and non-ASCII characters."""
    return text.translate(ALNUM).split()


def space_words(text: bytes) -> list[bytes]:
    """Lower-cased runs of anything but ASCII white space."""
    return text.translate(LOWER).split()


def values(batch: pa.RecordBatch, column: str) -> pa.Array:
    """A column, or a field of a struct column as ``column.field``."""
    name, _, field = column.partition(".")
    return pc.struct_field(batch.column(name), field) if field else batch.column(name)


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about SLICE_BYTES (of a list, items) of ``column`` or a single row."""
    held_in = values(batch, column)
    length = pc.list_value_length if pa.types.is_list(held_in.type) else pc.binary_length
    sizes = pc.fill_null(length(held_in), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def raw(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; null reads as empty."""
    return [t or b"" for t in values(batch, column).cast(pa.binary()).to_pylist()]


def plain(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts as str; null reads as empty."""
    return [t or "" for t in values(batch, column).to_pylist()]


def map_texts(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str,
              column: str = "text") -> DataFrame:
    """Apply a function of record batches to slices of ``df``.

    ``make`` runs once in each task and returns that function, so what it builds is built per task.
    """
    limit_batches(df.sparkSession)

    def run(batches):
        work = make()
        for batch in batches:
            for piece in slices(batch, column):
                yield work(piece)
    return df.mapInArrow(run, schema)


def limit_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

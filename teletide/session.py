"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

# Largest table handed to every executor, counted as 32 bytes per row and column plus the texts.
BROADCAST_BYTES = 64 << 20

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="teletide-")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for intermediate tables and streaming checkpoints.

    It lies below ``spark.checkpoint.dir``, which on a cluster names storage every executor shares.
    Only a local session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_base()
    return f"{base.rstrip('/')}/teletide/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage of iterative jobs so that a lost executor costs one file read, not a replay of
    every round, and gives the next round exact sizes to plan its joins with.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_small(df: DataFrame, purpose: str) -> tuple[DataFrame, bool]:
    """Materialize ``df`` and tell whether its measured size allows a broadcast."""
    stored = materialize(df, purpose)
    texts = [F.coalesce(F.sum(F.length(F.col(f"`{f.name}`"))), F.lit(0))
             for f in df.schema.fields if isinstance(f.dataType, StringType)]
    rows, *lengths = stored.agg(F.count("*"), *texts).first()
    return stored, rows * 32 * len(df.columns) + sum(lengths) <= BROADCAST_BYTES

"""Dropping repeated metric points while they stream in."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from teletide.operators.duplicates import SERIES, with_series

RECENT = 262_144
SHARDS = 64


def reject_stream(points: DataFrame, columns: list[str], arrival: list[str],
                  recent: int = RECENT, shards: int = SHARDS) -> DataFrame:
    """The first point of each (series, instant); later repeats are dropped.

    There is no event-time watermark, so late or out-of-order points always pass. The guard remembers
    the latest ``recent / shards`` accepted instants of each shard of a series. It is split by a hash of the instant, so that
    the points of one busy series are checked by up to ``shards`` tasks; equal instants share a shard.
    Keep ``shards`` for the life of a checkpoint.
    ``columns`` are the columns to keep; within a micro-batch the smallest ``arrival`` comes first.
    """
    kept = list(dict.fromkeys([*SERIES, "point_time", *columns]))
    rows = with_series(points.select(*kept)).withColumn(
        "_shard", F.pmod(F.xxhash64("point_time"), F.lit(shards)).cast("int"))
    bound = -(-recent // shards)

    def guard(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        accepted = list(state.get[0]) if state.exists else []
        seen = set(accepted)
        fresh = None
        for frame in frames:
            new = frame[~frame["point_time"].isin(seen)][kept]
            fresh = new if fresh is None else pd.concat([fresh, new])
            fresh = fresh.sort_values(arrival, kind="stable").drop_duplicates("point_time")
        if fresh is not None and len(fresh):
            fresh = fresh.sort_values(arrival, kind="stable")
            accepted.extend(int(t) for t in fresh["point_time"])
            state.update((accepted[-bound:],))
            yield fresh

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema)
    return rows.groupBy("_series", "_shard").applyInPandasWithState(
        guard, outputStructType=out, stateStructType="accepted array<bigint>",
        outputMode="append", timeoutConf=GroupStateTimeout.NoTimeout)

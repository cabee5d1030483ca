"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from teletide.session import materialize

# Edges that one task joins by itself, in 16 MB.
EDGES_IN_TASK = 1 << 20


def _state(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _lowest(pairs: DataFrame) -> DataFrame:
    """Each node's smallest neighbour, itself included; partial minima shrink a hub before the shuffle."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _in_one_task(edges: DataFrame) -> DataFrame:
    """Components of few edges: labels sink along the edges and are followed to their end, until nothing changes."""
    def run(batches):
        held = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
        if not held:
            return
        u, v = (np.concatenate(x) for x in zip(*held, strict=True))
        ids, ends = np.unique(np.append(u, v), return_inverse=True)
        u, v = ends[:len(u)], ends[len(u):]
        label = np.arange(len(ids))
        while True:
            before = label.copy()
            low = np.minimum(label[u], label[v])
            # The label of an end, not just the end, is lowered, so that what it stands for comes along.
            np.minimum.at(label, before[u], low)
            np.minimum.at(label, before[v], low)
            while (label[label] != label).any():
                label = label[label]
            if (label == before).all():
                break
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ids[label], pa.int64())], names=["id", "component"])
    return edges.coalesce(1).mapInArrow(run, "id long, component long")


def connected(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph given as columns ``a`` and ``b`` (bigint).

    Returns (id, component) for every node of an edge between two different nodes; ``component`` is the
    smallest node reachable. Loops and rows with a null end are ignored, repeated edges count once, no
    edges give no rows. Each round links a node's larger neighbours, then its smaller ones, to the smallest
    of them and writes the new edges to shared storage. The number of rounds is logarithmic; a hub is
    spread by partial aggregation and by splitting skewed joins. Up to EDGES_IN_TASK different edges, by their
    count, are joined in one task instead.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .distinct(), "edges")
    if now.count() <= EDGES_IN_TASK:
        return _in_one_task(now)
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_lowest(both), "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = _lowest(large)
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        then = materialize(small, "edges")
        after = _state(then)
        if after == state:
            break
        now, state = then, after
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)

"""Embedding near-dedup: p-stable hashing of normalised vectors, then exact cosines inside the buckets."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from teletide.llm.components import connected
from teletide.session import materialize

# Width of a projection's buckets, for vectors of length one.
WIDTH = 2.0
# The chance, at the threshold itself, that a pair meets in some table; closer pairs meet more often.
RECALL = 0.95
# Unrelated vectors that share a vector's bucket in one table, on average.
STRAYS = 0.1
# Members of a bucket that one task compares at once, and rows of the tiles in which it does.
BLOCK, TILE = 8192, 512
_SEED = 20


def _same_bucket(distance: float, width: float) -> float:
    """The chance that one Gaussian projection puts two vectors of this distance in one bucket."""
    r = width / distance
    below = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(vectors: int, threshold: float) -> tuple[int, int]:
    """(projections of a table, tables): more projections as the vectors grow, and tables to keep RECALL."""
    near = _same_bucket(math.sqrt(2 - 2 * threshold), WIDTH)
    far = _same_bucket(math.sqrt(2), WIDTH)
    projections = max(4, math.ceil(math.log(max(vectors, 2) / STRAYS) / math.log(1 / far)))
    return projections, math.ceil(math.log(1 - RECALL) / math.log(1 - near ** projections))


class Tables:
    """The hash functions of all tables; the same wherever they are built."""

    def __init__(self, dims: int, projections: int, tables: int):
        rng = np.random.default_rng(_SEED)
        self.lines = rng.standard_normal((dims, tables * projections))
        self.shift = rng.uniform(0, WIDTH, tables * projections)
        self.codes = rng.integers(1, 1 << 62, (tables, projections)).astype(np.uint64) | np.uint64(1)
        self.number = np.arange(1, tables + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """A 64-bit bucket key for each vector and table."""
        cells = np.floor((unit @ self.lines + self.shift) / WIDTH).astype(np.int64).view(np.uint64)
        keys = (cells.reshape(len(unit), *self.codes.shape) * self.codes).sum(axis=2, dtype=np.uint64) + self.number
        keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (keys ^ (keys >> np.uint64(32))).view(np.int64)


def _units(column: pa.Array) -> np.ndarray:
    """The vectors of a binary column of doubles, scaled to length one."""
    rows = column.to_pylist()
    wide = np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)  # squares stay finite
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the pairs connect, at most one for each node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = label.copy()
        np.minimum.at(low, x, label[y])
        np.minimum.at(low, y, label[x])
        low = low[low]
        if (low == label).all():
            break
        label = low
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


class Comparer:
    """Exact cosines of the members of a bucket."""

    def __init__(self, dims: int, projections: int, tables: int, threshold: float):
        self.tables, self.threshold = Tables(dims, projections, tables), threshold

    def bucket(self, key: int, unit: np.ndarray, ids: np.ndarray, sizes: np.ndarray, first: np.ndarray | None) -> list[tuple]:
        """(id, links, None) and edges (id, 0, other) of the pairs whose first common table this is.

        ``first`` marks the members of the first of two blocks; then only pairs across the blocks count.
        """
        counts = np.zeros(len(ids), np.int64)
        keys, edges = None, []
        for i in range(0, len(ids), TILE):
            for j in range(i, len(ids), TILE):
                near = unit[i:i + TILE] @ unit[j:j + TILE].T >= self.threshold
                if i == j:
                    near = np.triu(near, 1)
                x, y = np.nonzero(near)
                x, y = x + i, y + j
                if first is not None:
                    across = first[x] != first[y]
                    x, y = x[across], y[across]
                if not len(x):
                    continue
                if keys is None:
                    keys = self.tables.keys(unit)
                new = np.empty(len(x), bool)
                for k in range(0, len(x), 1 << 16):  # a pair that met in an earlier table counts there
                    p, q = x[k:k + (1 << 16)], y[k:k + (1 << 16)]
                    table = (keys[p] == keys[q]).argmax(axis=1)
                    new[k:k + len(p)] = keys[p, table] == key
                x, y = x[new], y[new]
                if len(x):
                    counts += np.bincount(x, sizes[y], len(ids)).astype(np.int64)
                    counts += np.bincount(y, sizes[x], len(ids)).astype(np.int64)
                    edges += zip(*(e.tolist() for e in _forest(ids[x], ids[y])), strict=True)
        out = [(int(ids[i]), int(counts[i]), None) for i in np.flatnonzero(counts)]
        return out + [(a, 0, b) for a, b in edges]


def _valid() -> F.Column:
    parts = F.col("embedding")
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists(parts, lambda x: x != 0), F.lit(False))


def _buckets(classes: DataFrame, projections: int, tables: int) -> DataFrame:
    """The members of every bucket that has several: key, blocks of the bucket, and the class."""
    def hashed(batches):
        made = None
        for batch in batches:
            if batch.num_rows:
                unit = _units(batch.column("v"))
                made = made or Tables(unit.shape[1], projections, tables)
                for i in range(0, len(unit), 1024):
                    keys = made.keys(unit[i:i + 1024])
                    yield pa.RecordBatch.from_arrays([batch.column("cid").slice(i, 1024), pa.array(list(keys), pa.list_(pa.int64()))],
                                                     names=["cid", "keys"])
    entries = materialize(classes.select("cid", "dims", "v").mapInArrow(hashed, "cid long, keys array<long>")
                          .select("cid", F.explode("keys").alias("key")), "buckets")
    busy = entries.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    return entries.join(busy, "key")


def _compared(classes: DataFrame, dims: int, threshold: float) -> DataFrame:
    """Link counts (id, links) and edges (id, other) of classes of one dimension."""
    n = classes.count()
    projections, tables = plan(n, threshold)
    members = _buckets(classes, projections, tables)
    # A bucket above BLOCK members is compared block by block, a pair of blocks in each group.
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    members = (members.withColumn("blocks", blocks).withColumn("mine", mine)
               .select("key", "cid", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
               .select("key", "cid", "mine", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high")))
    rows = (members.join(classes.select("cid", "size", "v"), "cid")
            .repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "cid"))

    def compare(batches):
        comparer, held = Comparer(dims, projections, tables, threshold), None

        def done(part):
            out = []
            key, low, high = (part.column(c).to_numpy() for c in ("key", "low", "high"))
            edge = np.flatnonzero((np.diff(key) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)) + 1
            unit, ids, sizes = _units(part.column("v")), part.column("cid").to_numpy(), part.column("size").to_numpy()
            mine = part.column("mine").to_numpy()
            cuts = np.concatenate([[0], edge, [len(key)]])
            pairs = np.flatnonzero(np.diff(cuts) == 2)  # most buckets: two members, compared all at once
            at = cuts[:-1][pairs]
            close = np.einsum("ij,ij->i", unit[at], unit[at + 1]) >= threshold
            skip = set(pairs[~close].tolist())
            for k, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist(), strict=False)):
                if k not in skip and b - a > 1:
                    first = mine[a:b] == low[a] if low[a] != high[a] else None
                    out += comparer.bucket(int(key[a]), unit[a:b], ids[a:b], sizes[a:b], first)
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)],
                                              names=["id", "links", "other"])
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            batch = table.to_batches()[0]
            # The last bucket may go on in the next batch.
            same = np.ones(batch.num_rows, bool)
            for c in ("key", "low", "high"):
                values = batch.column(c).to_numpy()
                same &= values == values[-1]
            whole = batch.num_rows - int(same[::-1].argmin() if not same.all() else batch.num_rows)
            if whole:
                yield done(batch.slice(0, whole))
            held = batch.slice(whole)
        if held is not None and held.num_rows:
            yield done(held)
    return materialize(rows.mapInArrow(compare, "id long, links long, other long"), "cosines")


def near_duplicates(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """How many vectors each vector is close to, and the component that its links put it in.

    ``vectors`` has vec_id and ``embedding``, an array of numbers. Two rows are linked if hashing brings them
    together and their cosine, in double precision, is at least ``threshold``; no pair below it is linked,
    and at least RECALL of the pairs at the threshold are found. Returns one row for each row: vec_id,
    n_links (other rows linked directly), component_id (the smallest vec_id that links lead to, its own
    included) and kept (vec_id = component_id). A vector that is null, empty or zero, holds a null or
    non-finite component, or has no vec_id links with nothing; vectors of different length do not link.
    Equal rows link with each other. An empty table gives no rows; other columns are not read.

    Equal vectors are collapsed before they are hashed. A normalised vector falls into one bucket of each
    table, by quantised Gaussian projections whose number follows from the number of vectors; all members of
    a bucket are compared, in blocks, and a pair counts in the first table that brings it together. Blocks
    return counts and a spanning forest, not pairs.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    valid = rows.where(_valid()).select("vec_id", "embedding", F.xxhash64("embedding").alias("h1"),
                                        F.xxhash64("embedding", F.lit(1)).alias("h2"), F.size("embedding").alias("dims"))
    packed = _packed(valid)
    classes = materialize(packed.groupBy("h1", "h2", "dims").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("size"), F.first("v").alias("v"))
        .withColumn("cid", F.monotonically_increasing_id()), "vectors")
    parts = [_compared(classes.where(F.col("dims") == r[0]), r[0], threshold)
             for r in classes.select("dims").distinct().orderBy("dims").collect()]
    found = classes.select("cid", "rep", "size", "h1", "h2").withColumn("links", F.col("size") - 1)
    if parts:
        pairs = parts[0]
        for part in parts[1:]:
            pairs = pairs.union(part)
        more = pairs.groupBy("id").agg(F.sum("links").alias("more")).withColumnRenamed("id", "cid")
        group = connected(pairs.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
        lowest = (group.join(classes.select(F.col("cid").alias("id"), "rep"), "id")
                  .groupBy("component").agg(F.min("rep").alias("lowest")))
        found = (found.join(more, "cid", "left").join(
            group.join(lowest, "component").select(F.col("id").alias("cid"), "lowest"), "cid", "left"))
    else:
        found = found.withColumn("more", F.lit(0)).withColumn("lowest", F.col("rep"))
    found = found.select("h1", "h2", (F.col("links") + F.coalesce("more", F.lit(0))).alias("n_links"),
                         F.coalesce("lowest", "rep").alias("component_id"))
    told = rows.withColumn("h1", F.when(_valid(), F.xxhash64("embedding"))).withColumn("h2", F.xxhash64("embedding", F.lit(1)))
    return (told.select("vec_id", "h1", "h2").join(found, ["h1", "h2"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def _packed(valid: DataFrame) -> DataFrame:
    """The embedding as bytes of doubles."""
    def pack(batches):
        for batch in batches:
            lists = batch.column("embedding")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).tobytes()
            ends = np.cumsum(batch.column("dims").to_numpy(), dtype=np.int64) * 8
            bytes_ = [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec_id", "h1", "h2", "dims")), pa.array(bytes_, pa.binary())],
                                             names=["vec_id", "h1", "h2", "dims", "v"])
    return valid.mapInArrow(pack, "vec_id long, h1 long, h2 long, dims int, v binary")

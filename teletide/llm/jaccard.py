"""N-gram Jaccard join: which documents are linked by similar sets of word n-grams, and their components.

The different sets are rows and the n-grams columns of a sparse incidence matrix, whose product with its transpose holds
the overlaps. It is formed in blocks of columns, and size bounds keep it small:

* A row only enters the columns of its prefix, its first n-grams in the order of their hashes, which is chosen so long
  that two linked rows share several columns of it (``shares``), not just one.
* Columns with one row are dropped; so are rows that are left with fewer columns than any link needs. The rows left are
  looked at in all their columns: one with too few that it shares with any other row is dropped too. What remains are
  near copies and rows made of common passages, not those that quote one.
* The rows left are dealt into blocks, rows with the same smallest n-gram side by side, and a task multiplies one block
  with another or with itself, over the columns that both hold. It accumulates the overlaps of their rows in one matrix
  of bounded size, leaves out pairs of too unequal sizes and those below the overlap that their sizes require, and gives
  out a forest of the links instead of all of them. A column of k rows sends an entry to as many tasks as blocks hold the
  column, so what is shuffled grows by k * k / BLOCK_ROWS at most, and no pair leaves a task that is not a link.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from teletide.llm.components import connected
from teletide.llm.texts import map_texts, raw, space_words
from teletide.session import materialize, materialize_small

# Rows and entries of a block, about.
BLOCK_ROWS, BLOCK_ENTRIES = 1024, 1 << 20
# Pairs of entries that a task adds to its matrix at once.
PAIRS_AT_ONCE = 1 << 22
# Rows of a column that one task goes through; a longer one is dealt to several.
CELL_ROWS = 1 << 18
# Texts looked at, about, to find such columns. It decides how work is dealt, not what is linked.
SAMPLE_DOCS = 20_000
# Sets that a task remembers, so as to give out the prefix of each once.
KNOWN_SETS = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SIGN = np.uint64(1 << 63)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of hashed word n-grams."""

    def __init__(self, n: int):
        self.n, self.codes = n, {}

    def _codes(self, words: list[bytes]) -> np.ndarray:
        codes = self.codes
        if len(codes) > 500_000:
            codes.clear()
        for w in set(words).difference(codes):
            codes[w] = xxhash.xxh3_64_intdigest(w)
        return np.array([codes[w] for w in words], np.uint64)

    def set_of(self, text: bytes) -> np.ndarray:
        """The distinct n-grams of a text as sorted 64-bit hashes; with fewer words, all of them as one."""
        words = space_words(text)
        if not words:
            return np.empty(0, np.uint64)
        codes = self._codes(words)
        size = min(self.n, len(codes))
        grams = np.full(len(codes) - size + 1, size, np.uint64)
        for i in range(size):
            grams = grams * _ODD + codes[i:len(codes) - size + 1 + i]
        return np.unique(_mixed(grams))


def least_overlap(n: int, percent: int) -> int:
    """How many n-grams a set of ``n`` shares at least with one it is linked to."""
    return -(-percent * n // 100)


def shares(n: int) -> int:
    """How many n-grams the prefixes of two linked sets share, the smaller of both numbers."""
    return max(1, n // 12)


def prefix_size(n: int, percent: int) -> int:
    """The length of a prefix that leaves out so few n-grams that ``shares`` of any link's are in it.

    Of two linked sets take the one whose prefix ends first: it lacks ``least_overlap - shares`` n-grams, so of
    those in common at least ``shares`` are in it, and in the other prefix, which goes on beyond.
    """
    return min(n, n - least_overlap(n, percent) + shares(n)) if n else 0


def _shares(n: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(n / 12))


def _least(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100)


def _rows(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, size and 64-bit identity of the set of every row of ``docs``.

    ``prefix`` is that of the set, where its task met the set first, else empty.
    """
    def make():
        shingler, known = Shingler(n), set()

        def work(batch):
            sizes, sids, prefixes = [], [], []
            for text, doc in zip(raw(batch), batch.column("doc_id").is_valid().to_pylist(), strict=True):
                grams = shingler.set_of(text)
                sid = xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63)
                prefix = grams[:prefix_size(len(grams), percent)]  # sets are sorted by hash
                sizes.append(len(grams))
                sids.append(sid)
                new = doc and len(prefix) and sid not in known
                if new:
                    if len(known) >= KNOWN_SETS:
                        known.clear()
                    known.add(sid)
                prefixes.append(((prefix if new else prefix[:0]) ^ _SIGN).view(np.int64))  # signed numbers of the same order
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sids, pa.int64()),
                 pa.array(prefixes, pa.list_(pa.int64()))], names=["doc_id", "n", "sid", "prefix"])
        return work
    return map_texts(docs, make, "doc_id long, n long, sid long, prefix array<long>")


def _full_sets(docs: DataFrame, n: int) -> DataFrame:
    """The whole set of every row, with its identity."""
    def make():
        shingler = Shingler(n)

        def work(batch):
            sets = [shingler.set_of(t) for t in raw(batch)]
            sids = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) for s in sets]
            return pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                                              names=["sid", "grams"])
        return work
    return map_texts(docs, make, "sid long, grams array<long>")


def _hot_columns(rows: DataFrame) -> DataFrame:
    """Columns that a sample of the sets takes for longer than CELL_ROWS, with the number of cells to deal them to."""
    sets = rows.where("size(prefix) > 0").count()
    part = max(1, sets // SAMPLE_DOCS)
    seen = rows.where(F.pmod("sid", F.lit(part)) == 0).select(F.explode("prefix").alias("g")).groupBy("g").count()
    return seen.where(F.col("count") * part > CELL_ROWS).select("g", F.ceil(F.col("count") * part / CELL_ROWS).cast("int").alias("cells"))


def _shared_entries(rows: DataFrame) -> DataFrame:
    """The entries (g, sid) of columns with several sets, each once."""
    hot, small = materialize_small(_hot_columns(rows), "hot-columns")
    entries = rows.select("sid", F.explode("prefix").alias("g")).join(F.broadcast(hot) if small else hot, "g", "left")
    entries = entries.select("g", F.when(F.col("cells").isNotNull(), F.pmod(F.xxhash64("sid"), F.col("cells"))).otherwise(
        F.lit(-1)).cast("int").alias("cell"), "sid")

    def run(batches):
        columns = [np.empty(0, np.int64)] * 3
        linked = False  # whether the row held back is in one column with the row before it
        for batch in batches:
            g, cell, sid = (np.concatenate([held, batch.column(k).to_numpy()]) for k, held in enumerate(columns))
            if not len(g):
                continue
            column = (g[1:] == g[:-1]) & (cell[1:] == cell[:-1])
            fresh = np.append(True, ~column | (sid[1:] != sid[:-1]))  # copies of a set lie side by side
            g, cell, sid = g[fresh], cell[fresh], sid[fresh]
            column = (g[1:] == g[:-1]) & (cell[1:] == cell[:-1])
            before = np.append(linked, column)
            keep = before | np.append(column, False) | (cell >= 0)
            columns, linked = [x[-1:] for x in (g, cell, sid)], bool(before[-1])
            yield _batch(**{k: x[:-1][keep[:-1]] for k, x in (("g", g), ("sid", sid), ("cell", cell))})
        g, cell, sid = columns
        if len(g) and (linked or cell[0] >= 0):
            yield _batch(g=g, sid=sid, cell=cell)
    dealt = entries.repartition("g", "cell").sortWithinPartitions("g", "cell", "sid").mapInArrow(run, "g long, sid long, cell long")
    return dealt.select("g", "sid")


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns.values()], names=list(columns))


def _enough(entries: DataFrame, sets: DataFrame, needed: Column) -> DataFrame:
    """The sets with at least ``needed`` of some entries (g, sid)."""
    held = entries.groupBy("sid").agg(F.count("*").alias("m"))
    return sets.join(held, "sid").where(F.col("m") >= needed).select("sid", "n", "rep")


def _placed(entries: DataFrame, sets: DataFrame) -> DataFrame:
    """The entries with the block of their row and its place in there.

    Rows with the same smallest n-gram are in one block, or spread over several where they fill a quarter of one.
    """
    held = entries.groupBy("sid").agg(F.min("g").alias("low"), F.count("*").alias("m"))
    rows = materialize(sets.join(held, "sid"), "block-rows")
    count, size = rows.agg(F.count("*"), F.coalesce(F.sum("m"), F.lit(0))).first()
    blocks = max(1, -(-count // BLOCK_ROWS), -(-size // BLOCK_ENTRIES))
    full = F.greatest(F.count("*") * 4 / BLOCK_ROWS, F.sum("m") * 4 / BLOCK_ENTRIES)
    groups = rows.groupBy("low").agg(F.ceil(full).alias("parts"))
    rows = rows.join(groups, "low").withColumn("block", F.pmod(F.xxhash64("low", F.pmod(F.xxhash64("sid"), F.col("parts"))), F.lit(blocks)))
    place = F.row_number().over(Window.partitionBy("block").orderBy("sid")) - 1
    return entries.join(rows.select("sid", "n", "rep", "block", place.cast("long").alias("place")), "sid").drop("sid")


def _forest(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join what the edges (a, b) between ``size`` nodes join: a node and the smallest of its component."""
    label = np.arange(size)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            node = np.flatnonzero(label != np.arange(size))
            return node, label[node]


class _Product:
    """The product of one block of rows with another, or with itself: overlaps by the places of the rows."""

    def __init__(self, key: tuple[int, int]):
        self.key, self.same = key, key[0] == key[1]
        self.counts = np.zeros((0, 0), np.int32)
        self.about = [np.zeros((0, 2), np.int64), np.zeros((0, 2), np.int64)]  # n and rep of the rows of each side

    def add(self, g: np.ndarray, right: np.ndarray, place: np.ndarray, n: np.ndarray, rep: np.ndarray) -> None:
        """Whole columns, sorted by column, then side, the left one first."""
        for side in (0,) if self.same else (0, 1):
            here = slice(None) if self.same else right == side
            rows = place[here]
            if len(rows) and rows.max() >= len(self.about[side]):
                self.about[side] = np.pad(self.about[side], ((0, int(rows.max()) + 1 - len(self.about[side])), (0, 0)))
            self.about[side][rows] = np.stack([n[here], rep[here]], 1)
        height, width = len(self.about[0]), len(self.about[0 if self.same else 1])
        old = self.counts.shape
        if old != (height, width):
            self.counts = np.pad(self.counts, ((0, height - old[0]), (0, width - old[1])))
        first = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        ends = np.append(first[1:], len(g))
        middle = first if self.same else first + np.add.reduceat(~right, first)
        left = np.arange(len(g)) if self.same else np.flatnonzero(~right)
        column = np.searchsorted(first, left, "right") - 1
        times = ends[column] - middle[column]
        upto = np.cumsum(times)
        at = 0
        while at < len(left):
            stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
            t = times[at:stop]
            steps = np.arange(t.sum()) - np.repeat(np.cumsum(t) - t, t)
            cells = np.repeat(place[left[at:stop]] * width, t) + place[np.repeat(middle[column[at:stop]], t) + steps]
            if len(cells) * 16 > height * width:
                self.counts += np.bincount(cells, minlength=height * width).reshape(height, width).astype(np.int32)
            else:
                np.add.at(self.counts.reshape(-1), cells, 1)
            at = stop

    def links(self, percent: int) -> pa.RecordBatch:
        """A forest of the links, in reps."""
        a, b = np.nonzero(np.triu(self.counts, 1) if self.same else self.counts)
        left, right = self.about[0], self.about[0 if self.same else 1]
        shared, x, y = self.counts[a, b].astype(np.int64), left[a, 0], right[b, 0]
        ok = np.minimum(x, y) * 100 >= np.maximum(x, y) * percent
        ok &= shared * 100 >= (x + y - shared) * percent
        reps = left[:, 1] if self.same else np.concatenate([left[:, 1], right[:, 1]])
        node, root = _forest(a[ok], b[ok] + (0 if self.same else len(left)), len(reps))
        return _batch(a=reps[node], b=reps[root])


def _multiplied(placed: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between representatives that join the rows of each component: the product by pairs of blocks."""
    held = placed.groupBy("g", F.col("block").alias("other")).agg(F.count("*").alias("k"))
    met = placed.join(held, "g").where((F.col("block") != F.col("other")) | (F.col("k") > 1)).select(
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "g",
        (F.col("block") > F.col("other")).cast("long").alias("side"), "place", "n", "rep")

    def run(batches):
        product, held = None, [np.empty(0, np.int64)] * 7
        for batch in batches:
            columns = [np.concatenate([h, batch.column(k).to_numpy()]) for k, h in enumerate(held)]
            low, high, g = columns[:3]
            if not len(g):
                continue
            # The last column may go on in the next batch.
            cuts = np.flatnonzero((low[1:] != low[:-1]) | (high[1:] != high[:-1])) + 1
            column = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])))
            end = int(column[-1])
            held = [c[end:] for c in columns]
            starts = [0, *cuts[cuts < end].tolist(), end]
            for i, j in zip(starts, starts[1:], strict=False):
                if i < j:
                    key = int(low[i]), int(high[i])
                    if product and product.key != key:
                        yield product.links(percent)
                        product = None
                    product = product or _Product(key)
                    product.add(g[i:j], columns[3][i:j] > 0, *[c[i:j] for c in columns[4:]])
        if len(held[0]):
            key = int(held[0][0]), int(held[1][0])
            if product and product.key != key:
                yield product.links(percent)
                product = None
            product = product or _Product(key)
            product.add(held[2], held[3] > 0, *held[4:])
        if product:
            yield product.links(percent)
    dealt = met.repartition("low", "high").sortWithinPartitions("low", "high", "g", "side", "place")
    return dealt.mapInArrow(run, "a long, b long")


def links(docs: DataFrame, rows: DataFrame, reps: DataFrame, n: int, percent: int) -> DataFrame:
    """Edges (a, b) between representatives of sets that join the sets of each component."""
    shared = materialize(_shared_entries(rows), "shared")
    least = _least(F.col("n"), percent)
    sets = materialize(_enough(shared, reps, _shares(least)), "candidates")  # even with the smallest set it may be linked to
    ids, small = materialize_small(sets.select(F.col("rep").alias("doc_id")).distinct(), "candidate-ids")
    whole = _full_sets(docs.join(F.broadcast(ids) if small else ids, "doc_id", "left_semi"), n)
    entries = materialize(_shared_entries(materialize(whole.withColumnRenamed("grams", "prefix"), "whole-sets")), "entries")
    # A link covers the least part of a set, so that much of it is in columns with another one.
    sets = _enough(entries, sets, least)
    return materialize(_multiplied(materialize(_placed(entries, sets), "placed"), percent), "links")


def join_components(docs: DataFrame, n: int = 5, percent: int = 75) -> DataFrame:
    """The size of each document's set of word n-grams and the component that its links put it in.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a text of fewer than ``n`` words has
    all of them as its one n-gram. Two documents are linked if the overlap of their sets is at least
    ``percent`` percent of their union. Returns doc_id, n_shingles and component_id, the smallest doc_id that
    links lead to, for every row. A text that is null or has no word has an empty set and links with nothing.
    Rows of one doc_id are one document, linked by any of their texts; a row without a doc_id has no
    component and links nothing. An empty table gives no rows; other columns are not read. N-grams and equal
    sets are told apart by 64-bit hashes. Documents of one set are represented by the smallest doc_id of them.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = materialize(_rows(docs, n, percent), "incidence")
    named = rows.where("n > 0 and doc_id is not null")
    reps = materialize(named.groupBy("sid").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n")), "reps")
    edges = links(docs.where("doc_id is not null"), rows, reps, n, percent)
    # A doc_id with several texts joins their sets.
    several = named.groupBy("doc_id").agg(F.min("sid").alias("low"), F.max("sid").alias("high")).where("low <> high")
    own = named.join(several.select("doc_id"), "doc_id", "left_semi").select("doc_id", "sid").distinct().join(reps, "sid")
    edges = edges.union(own.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    found = connected(edges).withColumnRenamed("id", "rep")
    parts = reps.select("sid", "rep").join(found, "rep", "left").select("sid", F.coalesce("component", "rep").alias("component_id"))
    told = rows.select("doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("sid")).alias("sid"))
    told = told.join(parts, "sid", "left")
    # An empty text of a doc_id that has others belongs to them too.
    odd = named.select("doc_id").join(rows.where("n = 0 and doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi").distinct()
    return _with_others(told, materialize(odd, "odd-ids"))


def _with_others(told: DataFrame, odd: DataFrame) -> DataFrame:
    """Fill in the component of empty rows: that of the other rows of their doc_id, else the doc_id."""
    own = F.coalesce("component_id", "doc_id").alias("component_id")
    if odd.isEmpty():
        return told.select("doc_id", "n_shingles", own)
    others = told.where("component_id is not null").join(odd, "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min("component_id").alias("other"))
    return told.join(others, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "other", "doc_id").alias("component_id"))


def drop_linked(docs: DataFrame, n: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` with one document of each component left, the one with the smallest doc_id.

    Rows without a doc_id stay; of several rows of the remaining doc_id one stays.
    """
    found = join_components(docs, n, percent)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    kept = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    twice = materialize(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(
        F.col("doc_id").alias("_twice")), "repeated-ids")
    if twice.isEmpty():
        return kept
    again = kept.join(twice, kept["doc_id"] == twice["_twice"], "left_semi").dropDuplicates(["doc_id"])
    return kept.join(twice, kept["doc_id"] == twice["_twice"], "left_anti").unionByName(again)

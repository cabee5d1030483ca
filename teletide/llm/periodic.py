"""Periodic runs: stretches of a document's words that repeat with a period.

The suffixes of all texts of a slice are sorted together, each compared only with those of its own document. Suffix
classes are then united by decreasing length of the common prefix (LCP), as Kruskal's algorithm takes edges: a
class is an ordered set of positions, the smaller of two is put into the larger. Two positions that become neighbours
in a class at an LCP of at least their distance d begin a repeat of period d. Only the first position of a run has no
equal word before it, and at the LCP that first unites it with the next period nothing lies between them, so every
run is found once and with its smallest period.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from teletide.llm.texts import map_texts, raw

# Positions in one block of an ordered set; a longer block is halved.
PLACES = 1024


class Places:
    """An ordered set of positions in blocks, so that adding one moves a block's worth of them at most."""

    def __init__(self, first: int):
        self.blocks, self.lows, self.size = [[first]], [first], 1

    def __iter__(self):
        for block in self.blocks:
            yield from block

    def add(self, x: int) -> tuple[int, int]:
        """Put a new position in; returns its neighbours below and above, -1 where there is none."""
        k = max(bisect_left(self.lows, x) - 1, 0)
        block = self.blocks[k]
        at = bisect_left(block, x)
        below = block[at - 1] if at else -1
        above = block[at] if at < len(block) else self.lows[k + 1] if k + 1 < len(self.lows) else -1
        insort(block, x)
        self.lows[k], self.size = block[0], self.size + 1
        if len(block) > PLACES:
            half = len(block) // 2
            self.blocks.insert(k + 1, block[half:])
            self.lows.insert(k + 1, block[half])
            del block[half:]
        return below, above

    def after(self, x: int) -> int:
        """The next position above a member, -1 if none."""
        k = bisect_right(self.lows, x) - 1
        at = bisect_right(self.blocks[k], x)
        return self.blocks[k][at] if at < len(self.blocks[k]) else self.lows[k + 1] if k + 1 < len(self.lows) else -1


def _refined(group: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Number the runs of a sorted table: a row that is ``fresh`` starts a group of the rank of its place."""
    return np.maximum.accumulate(np.where(fresh, np.arange(len(group)), 0))


def suffixes(codes: np.ndarray, docs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours in suffix order that agree on ``least`` words or more, within their document.

    ``codes`` are the words of all documents one after another, ``docs`` the number of each word's document.
    Returns the places in suffix order and the common prefix with the next place, 0 where it is below ``least`` or
    the next place lies in another document. Prefixes are doubled, and only places whose prefix so far occurs
    again are sorted anew.
    """
    n = len(codes)
    ends = np.searchsorted(docs, docs, "right")  # where each word's document ends
    order = np.lexsort((codes, docs))
    fresh = np.ones(n, bool)
    fresh[1:] = (codes[order[1:]] != codes[order[:-1]]) | (docs[order[1:]] != docs[order[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = _refined(order, fresh)
    levels = [rank.astype(np.int32)]
    width = 1
    while True:
        alone = fresh & np.append(fresh[1:], True)
        open_ = np.flatnonzero(~alone)  # places in order whose group still has several
        if not len(open_):
            break
        at = order[open_]
        follow = np.where(at + width < ends[at], rank[np.minimum(at + width, n - 1)] + 1, 0)
        again = np.lexsort((follow, rank[at]))
        at, follow = at[again], follow[again]
        same = rank[at[1:]] == rank[at[:-1]]
        order[open_] = at
        differs = np.ones(len(at), bool)
        differs[1:] = ~same | (follow[1:] != follow[:-1])
        fresh[open_] = differs
        rank[at] = open_[_refined(at, differs)]
        width *= 2
        levels.append(rank.astype(np.int32))
    # The common prefix of neighbours: the largest widths on which their ranks agree, from the widest down.
    a, b = order[:-1].copy(), order[1:].copy()
    some = np.flatnonzero((levels[0][a] == levels[0][b]))
    x, y, common = a[some], b[some], np.zeros(len(some), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        width = 1 << k
        inside = (x < ends[a[some]]) & (y < ends[b[some]])
        agree = inside & (levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)])
        # Equal ranks of a text's end cover fewer words than the width; those agree on what is left of neither.
        agree &= (x + width <= ends[a[some]]) & (y + width <= ends[b[some]])
        x, y, common = x + agree * width, y + agree * width, common + agree * width
    lcp = np.zeros(n, np.int64)
    lcp[some] = np.where(common >= least, common, 0)
    return order, lcp


def find_runs(codes: np.ndarray, docs: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``least`` words and two periods, by start, then period.

    Starts are counted over all documents. A run has ``length - period`` words in common with itself one period
    later, at least half of it, so common prefixes below half of ``least`` begin none.
    """
    order, lcp = suffixes(codes, docs, -(-least // 2))
    edges = np.flatnonzero(lcp)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    classes: dict[int, Places] = {}
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def held(i: int, j: int) -> bool:
        return classes[root(i)].after(i) == j

    runs, begun = [], []
    levels = lcp[edges]
    last = (levels != np.append(levels[1:], 0)[:len(levels)]).tolist()
    for a, b, l, done in zip(order[edges].tolist(), order[edges + 1].tolist(), levels.tolist(), last, strict=True):
        a, b = root(a), root(b)
        one, two = classes.pop(a, None) or Places(a), classes.pop(b, None) or Places(b)
        if one.size < two.size:
            a, b, one, two = b, a, two, one
        parent[b], classes[a] = a, one
        before = -1
        for p in two:
            below, above = one.add(p)
            for i, j in ((below, p), (p, above)):
                d = j - i
                if (i, j) != (before, p) and i >= 0 <= j and d <= l and l + d >= least and (
                        i == 0 or docs[i - 1] != docs[i] or codes[i - 1] != codes[j - 1]):
                    begun.append((i, j))
            before = p
        if done:  # of an LCP, neighbours are those left when all of its classes are united
            runs += [(i, j + l - i, j - i) for i, j in set(begun) if held(i, j)]
            begun = []
    return sorted(runs)


def _batch_runs(texts: list[list[bytes]], least: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, with starts counted within it."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    codes = np.array([number[w] for words in texts for w in words], np.int64)
    sizes = np.array([len(words) for words in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(codes):
        docs = np.repeat(np.arange(len(texts)), sizes)
        for start, length, period in find_runs(codes, docs, least):
            k = int(docs[start])
            found[k].append((start - int(starts[k]), length, period))
    return found


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period."""
    if not runs:
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()])


def scan(docs: DataFrame, least: int = 12) -> DataFrame:
    """Every document's periodic runs and its text without the repeats.

    Words are runs of anything but ASCII white space, told apart by their bytes and numbered from 0. A run is a stretch
    of at least ``least`` words and two periods whose words one (smallest) period apart are equal and that no
    neighbouring word extends. Returns doc_id, n_words, ``runs`` (array of start, length, period; by start, then
    period) and ``collapsed``, the words outside all runs and those of each run's first period, joined by one space.
    One row for every row of ``docs``: a text that is null, empty or white space has no words, no runs and an empty
    ``collapsed``; rows with equal or null doc_id are told by themselves; other columns are not read; an
    empty table gives no rows. A very long text is searched whole, in memory of some 100 bytes a word and, where
    most words repeat, some 300; nothing is shuffled.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def make():
        def work(batch):
            texts = [t.split() for t in raw(batch)]  # of bytes, at the space and 0x09 to 0x0D
            found = _batch_runs(texts, least)
            flat = [r for runs in found for r in runs]
            columns = zip(*flat, strict=True) if flat else ((), (), ())
            values = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["start", "length", "period"])
            edges = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(len, texts), pa.int64()),
                 pa.ListArray.from_arrays(edges, values).cast(run_type),
                 pa.array([_collapsed(w, r).decode() for w, r in zip(texts, found, strict=True)], pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])
        return work
    return map_texts(docs.select("doc_id", "text"), make,
                     f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


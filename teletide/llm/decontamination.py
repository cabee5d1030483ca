"""Benchmark decontamination: a broadcast hash set of benchmark n-grams against the windows of documents."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from teletide.llm.texts import ALNUM, alnum_words, map_texts, raw
from teletide.session import materialize

# Benchmark text that one broadcast set is built from; more is scanned in as many passes as it takes.
BLOCK_BYTES = 8 << 20
_BASE = 0x9E3779B97F4A7C15


class GramSet:
    """The n-grams of some benchmark items, by length, as word numbers with rolling hashes."""

    def __init__(self, items: list[tuple[int | None, bytes]], n: int):
        self.words: dict[bytes, int] = {}
        self.grams: dict[int, dict[bytes, set]] = {}
        for item, text in items:
            ids = [self.words.setdefault(w, len(self.words) + 1) for w in alnum_words(text)]
            size = min(n, len(ids))
            if not size:
                continue
            row = np.array(ids, np.int64)
            owners = self.grams.setdefault(size, {})
            for i in range(len(ids) - size + 1):
                owners.setdefault(row[i:i + size].tobytes(), set()).add(item)
        self.codes = np.random.default_rng(7).integers(1, 1 << 62, len(self.words) + 1).astype(np.uint64)
        self.hashes = {}
        for size, owners in self.grams.items():
            rows = np.frombuffer(b"".join(owners), np.int64).reshape(-1, size)
            self.hashes[size] = np.unique((self.codes[rows] * self._powers(size)).sum(axis=1, dtype=np.uint64))

    @staticmethod
    def _powers(count: int, base: int = _BASE) -> np.ndarray:
        row = np.full(count, base, np.uint64)
        if count:
            row[0] = 1
        return np.cumprod(row, dtype=np.uint64)

    def scan(self, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], set]]:
        """Of each text: its number of words, the hit word ranges [start, end) and the items found."""
        lookup, ids, ends = self.words.get, [], []
        for text in texts:
            ids.extend([lookup(w, 0) for w in alnum_words(text)])
            ids.append(0)  # no window reaches into the next text
            ends.append(len(ids))
        row = np.array(ids, np.int64)
        starts = np.array([0, *ends[:-1]])
        hit = np.zeros(len(row), bool)
        found: dict[int, set] = {}
        at = np.arange(len(row))
        since = at - np.maximum.accumulate(np.where(row == 0, at, -1))  # known words in a row up to here
        total = None
        for size, hashes in self.hashes.items():
            last = np.flatnonzero(since >= size)
            if not len(last):
                continue
            if total is None:
                total = np.concatenate([[np.uint64(0)], np.cumsum(self.codes[row] * self._powers(len(row)), dtype=np.uint64)])
                undo = self._powers(len(row), pow(_BASE, -1, 1 << 64))
            first = last - size + 1
            keys = (total[last + 1] - total[first]) * undo[first]
            near = hashes[np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)] == keys
            for i in first[near].tolist():
                owners = self.grams[size].get(row[i:i + size].tobytes())  # the words themselves, not the hash
                if owners:
                    hit[i:i + size] = True
                    found.setdefault(int(np.searchsorted(starts, i, "right")) - 1, set()).update(owners)
        out = []
        for k, (a, b) in enumerate(zip(starts.tolist(), ends, strict=True)):
            if k in found:
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[a:b].view(np.int8), [0]])))
                out.append((b - a - 1, [tuple(x) for x in edge.reshape(-1, 2).tolist()], found[k]))
            else:
                out.append((b - a - 1, [], set()))
        return out


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _scanned(docs: DataFrame, benchmark: DataFrame, n: int) -> DataFrame:
    """Each document as struct ``row`` with what was found in it."""
    grams = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    held = grams.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, math.ceil(held / BLOCK_BYTES))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.lit(0).cast("long").alias("n_words"),
                       F.expr("cast(array() as array<struct<start:long,end:long>>)").alias("hits"),
                       F.expr("cast(array() as array<long>)").alias("items"))
    for k in range(passes):
        block = grams if passes == 1 else grams.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        grams_of = GramSet([(r[0], r[1].encode()) for r in block.collect()], n)

        def make(known=grams_of):
            def work(batch):
                got = known.scan(raw(batch, "row.text"))
                before = zip(batch.column("hits").to_pylist(), batch.column("items").to_pylist(), strict=True)
                hits, items = [], []
                for (_, ranges, owners), (old, listed) in zip(got, before, strict=True):
                    spans = _merged(ranges + [(r["start"], r["end"]) for r in old]) if old else ranges
                    hits.append([{"start": a, "end": b} for a, b in spans])
                    items.append(sorted(owners.union(listed) - {None}))
                span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
                return pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array([g[0] for g in got], pa.int64()), pa.array(hits, pa.list_(span)),
                     pa.array(items, pa.list_(pa.int64()))], names=["row", "n_words", "hits", "items"])
            return work
        rows = map_texts(rows, make, rows.schema, "row.text")
        if k + 1 < passes:
            rows = materialize(rows, "benchmark-hits")
    return rows


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    """Where benchmark n-grams occur in documents.

    Words are lower-cased runs of ASCII letters, digits and non-ASCII characters. Every ``n`` consecutive
    words of an item are a window; an item of fewer words is one window, an item without words none.
    Returns doc_id and text of every row of ``docs`` with n_words, ``hits`` (word ranges inside any
    occurrence) and ``items`` (sorted ids of the items found). A null or empty text has no words and no
    hits. Repeated documents are reported once each, repeated items count once; an item without an id hits
    words but is not listed. An empty benchmark hits nothing. Other columns are not read.

    The benchmark is measured first. Each pass broadcasts the set of at most BLOCK_BYTES of its text (or a
    single longer item) and scans the documents without a shuffle; a larger benchmark takes more passes,
    with the hits so far written to shared storage in between.
    """
    return _scanned(docs.select("doc_id", "text"), benchmark, n).select("row.doc_id", "row.text", "n_words", "hits", "items")


def hit_words() -> F.Column:
    """The number of words in ``hits``."""
    return F.aggregate("hits", F.lit(0).cast("long"), lambda total, r: total + r["end"] - r["start"])


def contaminated(share: int = 20) -> F.Column:
    """Whether at least one word and one in ``share`` words of a scanned document are hit."""
    return (hit_words() > 0) & (hit_words() * share >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns and unchanged; see :func:`scan`."""
    return _scanned(docs, benchmark, n).where(~contaminated()).select("row.*")


def without_spans(docs: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    """Scanned documents whose hit words are cut out of ``text``, separators around them kept."""
    found = scan(docs, benchmark, n)

    def make():
        word = re.compile(rb"[^ ]+")

        def cut(text: bytes, spans: list[dict]) -> bytes:
            places = [m.span() for m in word.finditer(re.sub(rb"\s", b" ", text.translate(ALNUM)))]
            out, at = [], 0
            for s in spans:
                out.append(text[at:places[s["start"]][0]])
                at = places[s["end"] - 1][1]
            return b"".join([*out, text[at:]])

        def work(batch):
            texts = [t if not spans else cut(t.encode(), spans).decode() for t, spans in
                     zip(batch.column("text").to_pylist(), batch.column("hits").to_pylist(), strict=True)]
            return batch.set_column(1, "text", pa.array(texts, pa.string()))
        return work
    return map_texts(found, make, found.schema)

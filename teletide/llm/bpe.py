"""Byte-level BPE by merge replay over a block of the corpus."""

from __future__ import annotations

import base64
import heapq
from array import array
from collections import defaultdict
from itertools import count, islice

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from teletide.llm.texts import limit_batches, map_texts, raw, slices

# Distinct words whose encoding a task remembers; beyond it the memory starts anew.
KNOWN_WORDS = 200_000
# Text whose distinct words are merged together.
BLOCK_BYTES = 4 << 20
# The first byte of the characters that may be classed differently, see Splitter.
_ODD_BYTE = 0xD5


def load_ranks(path: str) -> dict[bytes, int]:
    """The rank of each token of a rank file; as many as the vocabulary has, whatever the corpus."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Splitter:
    """Cuts text at the matches of a pattern, with letters and numbers classed as the tiktoken library does.

    The two regular expression libraries follow different versions of Unicode. A character that only one of
    them knows is matched through a stand-in of the class that tiktoken gives it. All of these are encoded
    with a first byte of 0xD5 or more, so most texts need no look at them.
    """

    def __init__(self, pattern: str):
        self.find = regex.compile(pattern)
        self.swap: dict[int, str] | None = None

    def _odd(self) -> dict[int, str]:
        single = {bytes([i]): i for i in range(256)}
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        theirs, ours = {}, {}
        for name in (r"\p{L}", r"\p{N}"):
            coder = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
            theirs |= dict.fromkeys(bytes(coder.encode_ordinary(every)).decode(), name)
            ours |= dict.fromkeys(regex.findall(name, every), name)
        stand_in = {r"\p{L}": "一", r"\p{N}": "Ⅰ", None: ""}
        return {ord(c): stand_in[theirs.get(c)] for c in theirs.keys() | ours.keys() if theirs.get(c) != ours.get(c)}

    def __call__(self, text: bytes) -> list[str]:
        plain = text.decode()
        if not text or np.frombuffer(text, np.uint8).max() < _ODD_BYTE:
            return self.find.findall(plain)
        if self.swap is None:
            self.swap = self._odd()
        return [plain[m.start():m.end()] for m in self.find.finditer(plain.translate(self.swap))]


class Merges:
    """The vocabulary as arrays: which neighbouring tokens merge, and into what."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.length = np.zeros(size, np.int32)
        rows = array("q")
        for token, rank in ranks.items():
            self.length[rank] = len(token)
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    rows.extend((a * size + b, rank))
        keys, made = np.array(rows or (0, -1), np.int64).reshape(-1, 2).T
        order = np.argsort(keys)
        self.keys, self.made, self.size = keys[order], made[order], size
        # The earliest merge that a token can take part in; normally later than the token itself.
        self.earliest = np.full(size, size, np.int64)
        np.minimum.at(self.earliest, keys // size, made)
        np.minimum.at(self.earliest, keys % size, made)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank that each pair of tokens merges into, -1 if none."""
        keys = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.made[at], -1)


def replay(words: list[bytes], merges: Merges) -> list[bytes]:
    """Encode distinct words together by replaying the merges over all of them.

    The words lie one after another as linked symbols. An inverted index holds the places of the pairs that
    merge into each token; ranks are taken in order, every place of a rank is merged at once, and only the
    pairs beside a merge are looked up anew. A word that is a token itself is that token. Returns the ids as
    little-endian unsigned 32-bit integers.
    """
    whole = [merges.ranks.get(w) for w in words]
    left = [w for w, t in zip(words, whole, strict=True) if t is None and w]
    sizes = np.array([len(w) for w in left], np.int64)
    ends = np.cumsum(sizes)
    sym = merges.single[np.frombuffer(b"".join(left), np.uint8)]
    after, before = np.arange(1, len(sym) + 1), np.arange(-1, len(sym) - 1)
    after[ends - 1] = -1
    before[ends - sizes] = -1
    index: dict[int, list[np.ndarray]] = {}
    todo: list[int] = []

    def note(ranks: np.ndarray, places: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        cuts = [0, *(np.flatnonzero(np.diff(ranks)) + 1).tolist(), len(ranks)]
        for rank, a, b in zip(ranks[cuts[:-1]].tolist(), cuts, cuts[1:], strict=False):
            if rank in index:
                index[rank].append(places[a:b])
            else:
                index[rank] = [places[a:b]]
                heapq.heappush(todo, rank)

    def look(places: np.ndarray) -> None:
        got = merges.pairs(sym[places], sym[after[places]])
        if (some := got >= 0).any():
            note(got[some], places[some])

    look(np.flatnonzero(after >= 0))
    while todo:
        rank = heapq.heappop(todo)
        here = index.pop(rank)
        here = np.unique(np.concatenate(here)) if len(here) > 1 else here[0]  # noted in order of place
        right = after[here]
        # A pair is still there if its two symbols cover what the token covers.
        valid = (sym[here] >= 0) & (right >= 0)
        valid &= merges.length[sym[here]] + merges.length[sym[right]] == merges.length[rank]
        here, right = here[valid], right[valid]
        if not len(here):
            continue
        if len(here) > 1 and (right[:-1] == here[1:]).any():  # as in "aaa": the leftmost pair merges
            keep, last = [], -1
            for k, (p, q) in enumerate(zip(here.tolist(), right.tolist(), strict=True)):
                if p != last:
                    keep.append(k)
                    last = q
            here, right = here[keep], right[keep]
        if merges.earliest[rank] < rank:  # an earlier merge may become possible: one merge a word, then look again
            first = np.unique(np.searchsorted(ends, here, "right"), return_index=True)[1]
            rest = np.delete(here, first)
            if len(rest):
                note(np.full(len(rest), rank), rest)
            here, right = here[first], right[first]
        far = after[right]
        sym[here], sym[right], after[here] = rank, -1, far
        before[far[far >= 0]] = here[far >= 0]
        near = before[here]
        look(np.unique(np.concatenate([here[far >= 0], near[near >= 0]])))
    kept = sym >= 0
    flat = sym[kept].astype("<u4").tobytes()
    edges = (4 * np.cumsum(kept)[ends - 1]).tolist() if left else []
    merged = (flat[a:b] for a, b in zip([0, *edges], edges, strict=False))
    return [b"" if not w else next(merged) if t is None else t.to_bytes(4, "little")
            for w, t in zip(words, whole, strict=True)]


class Coder:
    """Encodes and decodes texts; remembers the words it has met."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merges, self.split = Merges(ranks), Splitter(pattern)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.ids: list[bytes] = []

    def cut(self, text: bytes) -> np.ndarray:
        """The words of a text as numbers."""
        number = self.number
        return np.array([number[w] for w in self.split(text)], np.int32)

    def encode(self, texts: list[np.ndarray]) -> list[bytes]:
        """The ids of cut texts as little-endian unsigned 32-bit integers."""
        new = list(islice(self.number, len(self.ids), None))
        self.ids += replay([w.encode() for w in new], self.merges)
        ids = self.ids
        return [b"".join([ids[w] for w in words.tolist()]) for words in texts]


def encode(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Each document's token ids.

    Returns doc_id and ``ids`` (binary, little-endian unsigned 32-bit) of every row; null and empty texts
    have no ids. Every match of ``pattern`` is encoded by itself, without special tokens. Repeated rows are
    encoded alike; other columns are not read. The replay runs over blocks: a block is BLOCK_BYTES
    of the texts of a task (or one longer text), its distinct words are merged together, and the words of
    earlier blocks are remembered. The vocabulary is
    read in the driver and sent along; nothing is shuffled, as joining encoded words back to the texts would move
    every occurrence of every word.
    """
    ranks = load_ranks(rank_file)

    limit_batches(docs.sparkSession)

    def run(batches):
        coder, names, texts, held = Coder(ranks, pattern), [], [], 0

        def out():
            rows = pa.RecordBatch.from_arrays(
                [pa.concat_arrays(names), pa.array(coder.encode(texts), pa.binary())], names=["doc_id", "ids"])
            if len(coder.number) > KNOWN_WORDS:
                coder.forget()
            return rows

        for batch in batches:
            for piece in slices(batch, "text"):
                names.append(piece.column("doc_id"))
                for text in raw(piece):
                    texts.append(coder.cut(text))
                    held += len(text)
                if held >= BLOCK_BYTES:
                    yield out()
                    names, texts, held = [], [], 0
        if names:
            yield out()
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, rank_file: str) -> DataFrame:
    """The bytes of token ids: doc_id, ids and ``decoded`` (binary); null ids decode to nothing.

    An id that the vocabulary does not have is an error.
    """
    ranks = load_ranks(rank_file)

    def make():
        tokens = {r: t for t, r in ranks.items()}  # all that decoding needs

        def text(ids: bytes) -> bytes:
            return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])

        def work(batch):
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"),
                 pa.array([text(i) for i in raw(batch, "ids")], pa.binary())], names=["doc_id", "ids", "decoded"])
        return work
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_texts(encoded.select("doc_id", "ids"), make, f"doc_id {kind}, ids binary, decoded binary", "ids")


def n_tokens() -> F.Column:
    """The number of ids in ``ids``."""
    return (F.octet_length("ids") / 4).cast("long")

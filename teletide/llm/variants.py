"""Spelling variants: words that one insertion, deletion or replacement makes into a much more frequent word.

PartEnum: the letters of a word, each numbered among its equals, are a set, that is a binary vector over all numbered
letters. One edit moves the vector by a Hamming distance of two at most. The letters of the corpus are dealt into
parts; two vectors at that distance agree on all parts but two at most, so each vector signs every choice of all parts
but two with its letters there, and near vectors share a signature. Equal signatures are joined by number, size
and a bit set of 128 for each vector, which rules out nearly all greater distances, and only then are the words of two
vectors compared letter by letter. Words of equal letters share one vector.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from teletide.session import materialize

LETTERS = "A-Za-zÀ-ÿ"
# From so many letters on, words are compared by halving: the time of levenshtein() grows with the square of the length.
LONG = 100
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def count_words(docs: DataFrame, shortest: int = 6, rarest: int = 5, letters: str = LETTERS,
                alter: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """word and n, how often it occurs, of the words of at least ``shortest`` letters and ``rarest`` occurrences.

    Words are maximal runs of ``letters`` (a character class without line feeds), A-Z lower-cased. ``alter`` may change the single
    occurrence, given its doc_id and lower-cased run; what it returns may be shorter by any number of letters but not
    longer. Rows are counted before the shuffle, so a frequent word reaches it once a task. A task holds the words of
    a line, not of a text.
    """
    # explode() would have each array made twice, first to drop the empty ones.
    lines = docs.select("doc_id", F.explode_outer(F.split("text", "\n")).alias("line"))
    runs = F.regexp_extract_all(F.translate("line", _UPPER, _LOWER), F.lit(f"[{letters}]{{{shortest},}}"), F.lit(0))
    words = lines.select("doc_id", F.explode_outer(runs).alias("word")).where("word is not null")
    if alter is not None:
        words = words.select(alter(F.col("doc_id"), F.col("word")).alias("word")).where(F.char_length("word") >= shortest)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= rarest)


def _marks(vector: str) -> tuple[int, int]:
    """A bit for each numbered letter, of 128 in two long values; different ones may share a bit."""
    bits, last, number = 0, "", 0
    for c in vector:
        last, number = c, number + 1 if c == last else 0
        bits |= 1 << (5 * ord(c) + 61 * number) % 128
    return tuple(x - (x >> 63 << 64) for x in (bits >> 64, bits & (1 << 64) - 1))


def _vectors(words: DataFrame) -> DataFrame:
    """Each different multiset of letters (``vector``, its letters in order), numbered, with its size and bits."""
    def run(batches):
        for batch in batches:
            vectors = batch.column("vector")
            high, low = zip(*(_marks(v.as_py()) for v in vectors), strict=True) if len(vectors) else ((), ())
            yield pa.RecordBatch.from_arrays([vectors, pa.array(high, pa.int64()), pa.array(low, pa.int64())], names=["vector", "high", "low"])
    found = words.select("vector").distinct().mapInArrow(run, "vector string, high long, low long")
    return found.select(F.monotonically_increasing_id().alias("id"), "vector", F.char_length("vector").alias("size"), "high", "low")


def _parts(vectors: DataFrame, parts: int) -> list[str]:
    """The letters dealt into parts, the most frequent ones first; as many rows are collected as there are letters."""
    seen = vectors.select(F.explode(F.split("vector", "")).alias("c")).where("c <> ''").groupBy("c").count()
    order = [r["c"] for r in sorted(seen.collect(), key=lambda r: (-r["count"], r["c"]))]
    return ["".join(order[k::parts]) for k in range(parts)]


def _near_vectors(vectors: DataFrame, parts: int) -> DataFrame:
    """Numbers (a, b), a < b, of vectors that one edit may bridge, each pair once, with the smaller size.

    All vectors at a Hamming distance of one or two are among them; a distance between the bits is never greater.
    """
    dealt = _parts(vectors, parts)
    # A signature is what is left of the ordered letters without those of two parts.
    signed = [F.xxhash64(F.lit(k), F.translate("vector", dealt[x] + dealt[y], "")) for k, (x, y) in enumerate(combinations(range(parts), 2))]
    entries = vectors.select("id", "size", "high", "low", F.explode(F.array(*signed)).alias("signature"))
    one, two = entries.alias("x"), entries.alias("y")
    apart = sum(F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in ("high", "low"))
    near = (F.col("x.id") < F.col("y.id")) & (F.abs(F.col("x.size") - F.col("y.size")) <= 1) & (apart <= 2)
    return one.join(two, (F.col("x.signature") == F.col("y.signature")) & near).select(
        F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.least("x.size", "y.size").alias("size")).distinct()


def _one_edit(one: str, two: str) -> Column:
    """Whether two different words are one edit apart: what follows their common start and the edit is equal."""
    m, n = F.char_length(one), F.char_length(two)
    same = F.aggregate(F.array(*[F.lit(1 << k) for k in range(29, -1, -1)]), F.lit(0), lambda at, step: F.when(
        (at + step <= F.least(m, n)) & (F.substring(one, at + 1, step) == F.substring(two, at + 1, step)), at + step).otherwise(at))
    rest = [F.substring(w, same + F.when(longer, 2).otherwise(1), length) for w, length, longer in ((one, m, m >= n), (two, n, n >= m))]
    return (F.abs(m - n) <= 1) & (rest[0] == rest[1])


def near_words(words: DataFrame, parts: int = 7) -> DataFrame:
    """Both directions (word, n, near, near_n) of all pairs of words that differ by exactly one edit.

    ``words`` has word, n and ``vector``, see ``with_vectors``. More ``parts`` make signatures longer and more.
    """
    vectors = materialize(_vectors(words), "vectors")
    pairs = materialize(_near_vectors(vectors, parts), "near-vectors")
    numbered = materialize(words.join(vectors, "vector").select("id", "word", "n"), "numbered-words")
    one = numbered.select(F.col("id").alias("a"), F.col("word").alias("one"), F.col("n").alias("n_one"))
    two = numbered.select(F.col("id").alias("b"), F.col("word").alias("two"), F.col("n").alias("n_two"))

    def compared(some: DataFrame, edit: Column) -> DataFrame:
        left = some.join(one, "a")
        # One row for both directions: a union would have each side joined and compared anew.
        ways = [F.struct(F.col(w).alias("word"), F.col(f"n_{w}").alias("n"), F.col(v).alias("near"), F.col(f"n_{v}").alias("near_n"))
                for w, v in (("one", "two"), ("two", "one"))]
        return left.join(two, (left["b"] == two["b"]) & edit).select(F.explode(F.array(*ways)).alias("way")).select("way.*")

    return compared(pairs.where(F.col("size") < LONG), F.levenshtein("one", "two", 1) == 1).unionByName(
        compared(pairs.where(F.col("size") >= LONG), _one_edit("one", "two")))


def with_vectors(words: DataFrame) -> DataFrame:
    """``words`` with the letters of each word in order."""
    return words.withColumn("vector", F.array_join(F.array_sort(F.split("word", "")), ""))


def _rooted(forms: DataFrame) -> DataFrame:
    """word and root, where forms lead to, by doubling the steps until none leads further.

    A form is ``ratio`` times as frequent as its word, so chains are short and have no cycle.
    """
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = now.join(after, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        then = materialize(step, "roots")
        if then.where("moved").isEmpty():
            return then.select("word", "root")
        now = then.select("word", "root")


def group(docs: DataFrame, shortest: int = 6, rarest: int = 5, ratio: int = 5, parts: int = 7,
          alter: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """The words of all texts with the frequent word that each is a variant of.

    Returns word, form, root, n, n_near and form_n for every word of ``count_words``. Near words differ by exactly one
    inserted, deleted or replaced code point; ``form`` is the near word of largest n (of equal ones the first in
    code-point order) if it occurs ``ratio`` times as often or more, else null; ``root`` is where forms lead to, the word
    itself if it has none; ``form_n`` is the form's n. ``ratio`` must be above 1. Null, empty and letterless texts hold
    no words, an empty table gives no rows, repeated rows count again, words of any length are compared whole, other
    columns are not read. A null doc_id is only seen by ``alter``.
    """
    if ratio <= 1:
        raise ValueError("a form must be more frequent than its words: ratio above 1")
    words = materialize(with_vectors(count_words(docs, shortest, rarest, alter=alter)), "words")
    best = near_words(words, parts).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    form_n = -F.col("best.less")
    has = form_n >= F.col("n") * ratio
    told = materialize(words.select("word", "n").join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(has, F.col("best.form")).alias("form"), F.when(has, form_n).alias("form_n")), "forms")
    roots = _rooted(told.where("form is not null"))
    return told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

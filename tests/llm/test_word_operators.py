"""Spelling variants, periodic runs and BPE with word ends against plain versions of their rules."""

import collections
import hashlib
import os
import random
import re
import time
import zlib

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from teletide.llm import periodic, queries, variants, word_bpe
from llm_texts import prose

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no warehouse tables here")


def table_texts():
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])
    return dict(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Spelling variants

def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain_variants(counts, ratio=5):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return out


def grouped(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_variants_against_all_pairs(docs):
    rng = random.Random(5)
    stems = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(5, 9))) for _ in range(40)]
    words = collections.Counter()
    for stem in stems:
        for _ in range(4):
            i, kind = rng.randrange(len(stem)), rng.randrange(3)
            w = stem[:i] + ("" if kind == 0 else rng.choice("abcdéz")) + stem[i + (kind < 2):]
            words[w] += rng.choice([1, 5, 6, 40, 300])
        words[stem] += rng.choice([5, 30, 200, 1500])
    words["chain" * 3] = 5
    words["chain" * 3 + "s"] = 25
    words["chain" * 3 + "st"] = 125
    texts = [None, "", " 12 - ", "Ähnlich ÄHNLICH"] + [f"{w.upper() if i % 2 else w}, " * n for i, (w, n) in enumerate(words.items())]
    counts = collections.Counter()
    for t in texts:
        counts.update(w.translate(str.maketrans(variants._UPPER, variants._LOWER)) for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""))
    counts = {w: n for w, n in counts.items() if n >= 5 and len(w) >= 6}
    expected = plain_variants(counts)
    assert expected["chain" * 3][1] == "chain" * 3 + "st" and any(v[3] > 2 for v in expected.values())
    for parts in (4, 7):
        assert grouped(variants.group(docs(texts), parts=parts)) == expected


def test_variants_of_long_repeated_and_missing_words(docs, odd_texts):
    long = "ab" * 20_000
    texts = [*odd_texts, *[f"{long}\n{long}x {long}x"] * 5, *["aaaaaa"] * 5, *["aaaaaaa"] * 25]
    got = grouped(variants.group(docs(texts, ids=[None] * len(texts))))
    assert got[long] == (None, long, 5, 1, None) and got[long + "x"][2:4] == (10, 1)
    assert got["aaaaaa"] == ("aaaaaaa", "aaaaaaa", 5, 1, 25)
    assert variants.group(docs([None, "", "short one"])).count() == 0 and variants.group(docs(["x"]).limit(0)).count() == 0
    with pytest.raises(ValueError, match="ratio"):
        variants.group(docs(["x"]), ratio=1)


def test_long_words_are_compared_in_time(docs):
    rng = random.Random(6)
    base = "".join(rng.choice("abcdefghijklmnop") for _ in range(200_000))
    near = [f"x{base}", base[:-1], f"{base[:70_000]}z{base[70_001:]}"]
    began = time.monotonic()
    got = grouped(variants.group(docs([base] * 25 + near * 5)))
    assert time.monotonic() - began < 100  # by levenshtein() a single pair takes longer
    assert got == {base: (None, base, 25, 3, None), **{w: (base, base, 5, 1, 25) for w in near}}


def test_words_around_the_length_of_long_ones(docs):
    rng = random.Random(7)
    counts = collections.Counter()
    for k in range(12):
        stem = "".join(rng.choice("aabcé") for _ in range(variants.LONG - 3 + k % 6))
        i, j = rng.randrange(len(stem) - 1), len(stem) - 1
        for w in (stem, stem[:i] + stem[i + 1:], f"{stem}é", f"a{stem}", f"{stem[:j]}x", f"x{stem[1:]}", stem[:i] + stem[i + 1] + stem[i] + stem[i + 2:]):
            counts[w] = rng.choice([5, 6, 25, 30])
    texts = [w for w, n in counts.items() for _ in range(n)]
    expected = plain_variants(counts)
    assert grouped(variants.group(docs(texts))) == expected and any(v[3] > 2 for v in expected.values())


def test_bits_of_letters_are_never_further_apart_than_the_letters():
    rng = random.Random(8)
    number = lambda w: [x % 2**64 for x in variants._marks("".join(sorted(w)))]
    for _ in range(3_000):
        word = "".join(rng.choice("aabcdeéÿz") for _ in range(rng.randrange(6, 300)))
        i, c = rng.randrange(len(word)), rng.choice("abyéÿ")
        for other in (word[:i] + word[i + 1:], word[:i] + c + word[i + 1:], word[:i] + c + word[i:]):
            assert sum((x ^ y).bit_count() for x, y in zip(number(word), number(other), strict=True)) <= 2
            assert all(-2**63 <= x < 2**63 for x in variants._marks("".join(sorted(other))))


def test_lines_of_a_text_are_taken_apart(docs):
    texts = ["kessel\nkessel\r\nkessel", "\nKESSEL\n\n", "kessel", None, "", "\n"]
    assert grouped(variants.group(docs(texts))) == {"kessel": (None, "kessel", 5, 0, None)}


@needs_tables
def test_variants_of_the_table(spark):
    counts = collections.Counter()
    for i, text in table_texts().items():
        for w in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(str.maketrans(variants._UPPER, variants._LOWER))):
            h = zlib.crc32(f"{i}:{w}".encode())
            counts[w[:h % len(w)] + w[h % len(w) + 1:] if h % 199 == 0 else w] += 1
    counts = {w: n for w, n in counts.items() if n >= 5 and len(w) >= 6}
    assert grouped(queries.spelling_variants(spark, SF)) == plain_variants(counts)


# Periodic runs

def plain_runs(words, least=12):
    found = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            part = words[start:start + length]
            smaller = any(part[p:] == part[:-p] for p in range(1, q))
            if length >= max(least, 2 * q) and not smaller:
                found.append((start, length, q))
    return sorted(found)


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


SPACES = re.compile("[^\x20\x09-\x0D]+")


def repeating_texts():
    rng = random.Random(9)
    out = []
    for k in range(150):
        words = [rng.choice("abcdé"[:rng.randrange(1, 6)]) for _ in range(rng.randrange(0, 90))]
        if words and k % 2:
            a = rng.randrange(len(words))
            p = 1 + (len(words) - a) // (3 + k % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
        out.append(rng.choice(["\n", "  ", "\t "]).join(words))
    return out


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs(docs, odd_texts, least):
    texts = [*odd_texts, *repeating_texts(), "Ha ha " * 40, "a\x1cb c " * 12, "a b c " * 12]
    for r in periodic.scan(docs(texts), least).collect():
        words = SPACES.findall(texts[r["doc_id"]] or "")
        if len(words) > 5000:  # the plain version is quadratic
            assert r["n_words"] == len(words)
            continue
        expected = plain_runs(words, least)
        assert (r["n_words"], [tuple(x) for x in r["runs"]]) == (len(words), expected)
        assert r["collapsed"] == plain_collapsed(words, expected)


def test_runs_of_very_long_texts_and_repeated_rows(docs):
    word = "so " * 120_000
    stretch = (prose(3, 3000) + " ") * 40
    texts = [word, stretch, word, None]
    got = {r["doc_id"]: r for r in periodic.scan(docs(texts, ids=[1, 2, 3, None])).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(0, 120_000, 1)] and got[1]["collapsed"] == got[3]["collapsed"] == "so"
    assert (0, 120_000, 3000) in [tuple(x) for x in got[2]["runs"]]
    assert got[None]["runs"] == [] and periodic.scan(docs(texts).limit(0)).count() == 0


@needs_tables
def test_runs_of_the_table(spark):
    got = {r["doc_id"]: r for r in queries.periodic_runs(spark, SF).collect()}
    several = 0
    for i, text in table_texts().items():
        words = SPACES.findall(text or "")
        h = zlib.crc32(str(i).encode())
        if h % 10 == 0 and words:
            g = h // 10
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(len(words))]
        if len(words) > 4000:
            continue
        runs = plain_runs(words)
        several += bool(runs)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        r = got[i]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *top)
        assert r["exponent_milli"] == (top[1] * 1000 // top[2] if runs else None)
        assert r["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r["collapsed_sha256"] == sha(plain_collapsed(words, runs))
    assert several > 10


# BPE with word ends

def library(texts):
    coder = Tokenizer.from_file(PATH)
    ids = [coder.encode(t or "", add_special_tokens=False).ids for t in texts]
    return ids, [coder.decode(i, skip_special_tokens=False) for i in ids]


def test_word_bpe_as_the_library(docs, odd_texts):
    rng = random.Random(11)
    names = [t.removesuffix("</w>") for t in word_bpe.load(PATH).tokens]
    glued = ["".join(rng.choice(names) for _ in range(rng.randrange(1, 7))) for _ in range(400)]
    letters = ["".join(rng.choice("aeinrst'") for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    wide = ["".join(chr(rng.choice([rng.randrange(0x300), rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)]))
                    for _ in range(20)) for _ in range(200)]
    marks = ["<|endoftext|>a<|startoftext|> <|EndOfText|>", "It's WE'LL x'd 12345", "x" * 30_000, "Ώ ΑΣ İ é Å", "a\x85b\xa0c"]
    texts = [*odd_texts, *glued, *letters, *wide, *marks]
    got = {r["doc_id"]: r for r in word_bpe.decode(word_bpe.encode(docs(texts), PATH), PATH).collect()}
    ids, decoded = library(texts)
    assert [got[i]["ids"] for i in range(len(texts))] == ids
    assert [got[i]["decoded"] for i in range(len(texts))] == decoded


def test_word_bpe_classes_of_the_plain_path():
    v = word_bpe.load(PATH)
    plain, coder = word_bpe.Words(v), word_bpe.Encoder(v)
    texts = [f"a{chr(c)}B1{chr(c)} {chr(c)}" for c in range(0x300)]
    ids, _ = library(texts)
    assert [[int.from_bytes(x[k:k + 4], "little") for x in map(coder.__getitem__, plain(t)) for k in range(0, len(x), 4)]
            for t in texts] == ids


def test_word_bpe_empty_tables_and_ids(spark, docs):
    assert word_bpe.encode(docs(["x"]).limit(0), PATH).count() == 0
    df = spark.createDataFrame([(1, None), (2, []), (2, [320])], "doc_id long, ids array<int>")
    assert sorted((r["doc_id"], r["decoded"]) for r in word_bpe.decode(df, PATH).collect()) == [(1, ""), (2, ""), (2, "a</w>")]
    with pytest.raises(Exception, match="IndexError"):
        word_bpe.decode(spark.createDataFrame([(1, [-1])], "doc_id long, ids array<int>"), PATH).collect()


def test_word_bpe_forgets_words(docs, monkeypatch):
    coder = word_bpe.Encoder(word_bpe.load(PATH))
    monkeypatch.setattr(word_bpe, "KNOWN_WORDS", 3)
    monkeypatch.setattr(word_bpe, "KNOWN_PAIRS", 3)
    words = ["one", "another", "different", "<|endoftext|>", "one", "more", "<|endoftext|>"] * 2
    assert [len(coder[w]) for w in words] == [4] * len(words) and len(coder) <= 3


@needs_tables
def test_word_bpe_of_the_table(spark):
    texts = table_texts()
    got = {r["doc_id"]: r for r in queries.word_encoded(spark, SF).collect()}
    for (i, _), ids, decoded in zip(texts.items(), *library(texts.values()), strict=True):
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (
            len(ids), sha(" ".join(map(str, ids))), sha(decoded))


def test_altered_words_of_a_checksum(spark):
    rows = [(i, f"word{c}".translate(str.maketrans("0123456789", "abcdefghij"))) for i in range(40) for c in range(30)]
    df = spark.createDataFrame([*rows, (None, "nodocument")], "doc_id long, run string")
    for r in df.select("*", queries._one_lost(F.col("doc_id"), F.col("run")).alias("out")).collect():
        h = zlib.crc32(f"{r['doc_id']}:{r['run']}".encode()) if r["doc_id"] is not None else 1
        w = r["run"]
        assert r["out"] == (w[:h % len(w)] + w[h % len(w) + 1:] if h % 199 == 0 else w)

"""Operators that compare rows against brute force on small tables, and the pipeline."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from teletide.llm import chat, components, embeddings, jaccard, linededup, queries

from llm_texts import prose


def union(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("in_task", [0, 1000])
def test_components(spark, monkeypatch, in_task):
    monkeypatch.setattr(components, "EDGES_IN_TASK", in_task)
    pairs = [(i, i + 1) for i in range(40)] + [(50, k) for k in range(60, 90)] + [(95, 95), (60, 50), (50, 60)]
    got = {r["id"]: r["component"] for r in components.connected(spark.createDataFrame([*pairs, (None, 3)], "a long, b long")).collect()}
    expected = union(100, pairs)
    assert got == {i: expected[i] for i in {x for p in pairs if p[0] != p[1] for x in p}}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def words_set(text):
    words = (text or "").encode().lower().split()  # bytes: only ASCII is lower-cased and split at
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_copies():
    base = prose(3, 120).split()
    out = []
    for k in range(30):
        words = list(base)
        for j in range(k % 6):
            words[(k * 17 + j * 23) % len(words)] = f"w{k}x{j}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("cell, block, pairs", [(4, 8, 50), (1 << 18, 1024, 1 << 22), (1 << 18, 3, 1)])
def test_jaccard_components(docs, odd_texts, monkeypatch, cell, block, pairs):
    monkeypatch.setattr(jaccard, "CELL_ROWS", cell)  # small ones: columns are dealt to several cells
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)  # and rows to many blocks
    monkeypatch.setattr(jaccard, "PAIRS_AT_ONCE", pairs)
    shared = prose(9, 60)
    texts = [*odd_texts, *near_copies(), *(prose(100 + i, 25) + " " + shared for i in range(20)), "one two", "One  two\n", "two one", *near_copies()[:3]]
    sets = [words_set(t) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    expected = union(len(texts), pairs)
    df = docs(texts)
    got = {r["doc_id"]: r for r in jaccard.join_components(df).collect()}
    assert [got[i]["component_id"] for i in range(len(texts))] == expected
    assert [got[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    kept = jaccard.drop_linked(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(expected))


def test_jaccard_odd_ids(docs):
    texts = [prose(1, 30), prose(1, 30), prose(2, 30), prose(2, 30), prose(1, 30)]
    got = [(r["doc_id"], r["component_id"]) for r in jaccard.join_components(docs(texts, [7, 7, 7, 9, None])).collect()]
    assert sorted(got, key=str) == sorted([(7, 7), (7, 7), (7, 7), (9, 7), (None, None)], key=str)
    assert sorted(str(r["doc_id"]) for r in jaccard.drop_linked(docs(texts, [7, 7, 7, 9, None])).collect()) == ["7", "None"]
    assert jaccard.join_components(docs([])).count() == 0


def test_jaccard_ids_with_several_texts(docs):
    rows = []
    for k in range(40):  # a document of two texts, a link of the second one, and a document that may lead their columns
        base = prose(500 + k, 60)
        rows += [(3 * k, None if k % 2 else prose(700 + k, 30)), (3 * k, base), (3 * k + 1, base + " and more"), (3 * k + 2, base + " " + prose(900 + k, 40))]
    ids = [i for i, _ in rows]
    sets = [words_set(t) for _, t in rows]
    pairs = [(ids[i], ids[j]) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    expected = union(120, pairs)
    got = jaccard.join_components(docs([t for _, t in rows], ids)).collect()
    assert len(got) == len(rows) and all(r["component_id"] == expected[r["doc_id"]] for r in got)


def test_prefixes_of_links_share_enough():
    rng = np.random.default_rng(4)
    for n in range(1, 400):
        first = rng.choice(10 ** 9, n, replace=False)
        kept = max(jaccard.least_overlap(n, 75), 1)
        second = np.append(rng.permutation(first)[:kept], rng.choice(10 ** 9, int(rng.integers(0, n // 16 + 1)), replace=False))
        both = len(np.intersect1d(first, second))
        if 100 * both < 75 * len(np.union1d(first, second)):
            continue
        x, y = (np.sort(s)[:jaccard.prefix_size(len(s), 75)] for s in (first, second))
        assert len(np.intersect1d(x, y)) >= min(jaccard.shares(len(first)), jaccard.shares(len(second)))


def test_block_product_counts_whatever_the_batches():
    rng = np.random.default_rng(8)
    for same in (True, False):
        left, right = rng.random((17, 60)) < 0.4, rng.random((23, 60)) < 0.4
        product = jaccard._Product((0, 0 if same else 1))
        for low in range(0, 60, 7):
            parts = [(g, side, place) for g in range(low, min(60, low + 7)) for side, m in enumerate((left,) if same else (left, right))
                     for place in np.flatnonzero(m[:, g])]
            if parts:
                g, side, place = (np.array(x) for x in zip(*parts, strict=True))
                product.add(g, side > 0, place, np.full(len(g), 24), place + 100 * side)
        expected = left.astype(int) @ (left if same else right).T.astype(int)
        assert (product.counts == expected[:product.counts.shape[0], :product.counts.shape[1]]).all()
        assert not np.any(expected[product.counts.shape[0]:])


@pytest.mark.parametrize("block", [5, 1024])
def test_jaccard_of_documents_made_of_common_lines(docs, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)
    lines = [prose(600 + i, 12) for i in range(14)]
    texts = [" ".join(lines[(start + k) % 14] for k in range(length)) for length in (8, 9, 10) for start in range(14)]
    sets = [words_set(t) for t in texts]
    expected = union(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])])
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join_components(docs(texts)).collect()}
    assert [got[i] for i in range(len(texts))] == expected


def plain_lines(texts, ids):
    keys = [[(line.strip(" \t\n\x0b\x0c\r")) for line in (t or "").split("\n")] for t in texts]
    keys = [["".join(c.lower() if "A" <= c <= "Z" else c for c in k) for k in row] for row in keys]
    holders = defaultdict(set)
    for i, row in zip(ids, keys, strict=True):
        for k in row:
            if len(k) >= 20 and i is not None:
                holders[k].add(i)
    out = []
    for i, t, row in zip(ids, texts, keys, strict=True):
        lines = (t or "").split("\n")
        keep = [x for x, k in zip(lines, row, strict=True) if i is None or len(holders[k]) < 3 or max(holders[k]) == i]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def test_line_dedup(docs, odd_texts):
    common, other = "a line that is in many documents", "Another line of some length é"
    texts = [*odd_texts, f"{common}\nx\n {common.upper()}\t\ny", f"{common}\n{common}", f"x\n{common}", f"{other}\nz", f"{other}\n{other}", other.upper(),
             "short\nshort", "short", "short", f"{common}\n\n"]
    ids = [*range(len(texts) - 1), None]
    df = docs(texts, ids)
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in linededup.kept_texts(df).select("row.doc_id", "*").collect()]
    assert sorted(got, key=str) == sorted(plain_lines(texts, ids), key=str)
    maps = {r["doc_id"]: r for r in linededup.keep_bitmaps(df).collect()}
    first = maps[len(odd_texts)]
    assert [tuple(r) for r in first["keep"]] == [(1, 2), (3, 4)] and first["n_dropped"] == 2
    assert linededup.kept_texts(docs([])).count() == 0


def test_line_dedup_repeated_rows(docs):
    line = "a line that is in many documents"
    texts, ids = [line, line, line, line, f"{line}\nx", f"{line}\nx"], [1, 1, 1, 2, 3, 3]
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in linededup.kept_texts(docs(texts, ids)).select("row.doc_id", "*").collect()]
    assert sorted(got) == sorted(plain_lines(texts, ids))
    assert linededup.kept_texts(docs(texts[:4], ids[:4])).where("n_dropped > 0").count() == 0  # two documents


def test_chat(spark):
    rows = [(1, 0, "user", "a<|im_end|>\\<\\|"), (1, 1, "assistant", "b\\\\<|im_start|>é"), (1, None, "sys\ntem", None), (1, 200, "assistant", ""),
            (1, 1, "assistant", "b\\\\<|im_start|>é"), (2, 5, None, "x"), (None, 1, "user", "<\\.\n<|")]
    rows += [(3, i, "assistant" if i % 2 else "user", f"turn {i} <|") for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("n", F.lit("extra"))
    chats = chat.format_chats(df.withColumn("parts", chat.text_part(F.col("text"))))
    got = {r["conv_id"]: r for r in chats.withColumn("turns", chat.parse(F.col("formatted"))).withColumn(
        "spoken", chat.loss_text(F.col("formatted"), F.col("loss"))).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -1, role or "", text or "") for c, t, role, text in rows if c == conv))
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == [(role, text) for _, role, text in turns]
        assert got[conv]["spoken"] == "".join(text for _, role, text in turns if role == "assistant")
        assert got[conv]["n_turns"] == len(turns)
        starts = [r["start"] for r in got[conv]["loss"]]
        assert starts == sorted(starts)
    assert chats.where("false").count() == 0 and chat.format_chats(df.limit(0).withColumn("parts", chat.text_part(F.col("text")))).count() == 0


def test_chat_parts(spark):
    parts = [("text", "see <|image|> ", None, None), ("image", None, "s3://x/1.png", None), ("audio", None, "2.wav", 40), ("odd", "!", None, None), ("document", "t", None, -3)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    row = chat.format_chats(df).first()
    assert row["formatted"] == "<|im_start|>user\nsee <\\|image|> <|image|><|audio|>!<|document|><|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert [tuple(a) for a in row["attachments"]] == [("image", "s3://x/1.png", 576), ("audio", "2.wav", 40), ("document", None, 0)]
    end = len(row["formatted"]) - len(chat.CLOSE)
    assert row["expanded_tokens"] == 616 and [tuple(r) for r in row["loss"]] == [(end, end)]


@pytest.mark.parametrize("block", [8192, 16])
def test_embeddings(spark, block, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", block)  # large buckets are compared block by block
    rng = np.random.default_rng(2)
    center = rng.normal(size=16)
    rows = [rng.normal(size=16).tolist() for _ in range(150)] + [(center + rng.normal(size=16) * s).tolist() for s in np.linspace(0.01, 0.6, 120)]
    rows += [rows[0], rows[0], [2 * x for x in rows[1]], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] * 16, None, [], [1e200] * 16, [1.0, 0.0]]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>").withColumn("label", F.lit(1)).withColumn("size", F.lit("x"))
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(df).collect()}
    valid = [i for i, r in enumerate(rows) if r and len(r) == 16 and None not in r and np.isfinite(r).all() and any(r)]
    wide = np.array([rows[i] for i in valid])
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    wide /= np.linalg.norm(wide, axis=1, keepdims=True)
    close = wide @ wide.T >= 0.9
    np.fill_diagonal(close, False)
    links = {i: int(c) for i, c in zip(valid, close.sum(axis=1), strict=True)}
    found, true = sum(r["n_links"] for r in got.values()), sum(links.values())
    assert len(got) == len(rows) and 0.97 * true <= found <= true
    assert all(got[i]["n_links"] <= links.get(i, 0) for i in got)
    expected = union(len(rows), [(valid[a], valid[b]) for a, b in np.argwhere(close)])
    assert sum(got[i]["component_id"] == expected[i] for i in got) >= len(rows) - 3
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in got)
    assert got[0]["n_links"] >= 2 and got[len(rows) - 7]["n_links"] == 0
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_more_vectors_more_tables():
    few, many = embeddings.plan(10_000, 0.9), embeddings.plan(10_000_000, 0.9)
    assert many[0] > few[0] and many[1] > few[1]


def test_pipeline(spark, docs, odd_texts, tmp_path):
    boiler = "a line that is in many documents"
    passage = prose(77, 40)
    texts = [*(f"{boiler}\n{prose(i, 60)}" for i in range(12)), *near_copies()[:4], f"{prose(50, 20)} {passage}", *odd_texts]
    df = docs(texts, langs=["en"] * len(texts))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    held, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        held = stage(spark, held, str(tmp_path))
        kept[name] = {r["doc_id"]: r for r in held.collect()}
        if name != "byte_level_bpe":
            assert held.columns == df.columns
    told = {i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))}
    assert set(kept["language_id"]) == told
    after = {i: x for i, _, _, x in plain_lines([texts[i] for i in sorted(told)], sorted(told))}
    assert {i: r["text"] for i, r in kept["line_dedup"].items()} == after
    assert all(r["n_chars"] == len(r["text"]) for r in kept["line_dedup"].values())
    groups = Counter()
    sets = {i: words_set(t) for i, t in after.items()}
    order = sorted(told)
    pairs = [(a, b) for a in order for b in order if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    roots = union(len(texts), pairs)
    groups.update(roots[i] for i in order)
    assert set(kept["ngram_jaccard_join"]) == set(groups)
    assert set(kept["ngram_jaccard_join"]) - set(kept["benchmark_decontamination"]) == {16}
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(rows) == set(kept["benchmark_decontamination"])
    assert all(r["decoded_sha256"] == hashlib.sha256(after[i].encode()).hexdigest() for i, r in rows.items())
    assert queries.QUERIES.keys() == {q for q in queries.QUERIES if q.startswith("op")} and len(queries.QUERIES) == 13

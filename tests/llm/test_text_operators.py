"""Operators on single documents against plain versions of their rules."""

import base64
import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from teletide.llm import bpe, decontamination, language, licenses, pii, queries, secret_scan
from teletide.llm.automaton import Automaton, read

from llm_texts import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def hit_words(text, items, n=13):
    words = WORD.findall(lower(text))
    hit, found = set(), set()
    for item, phrase in items:
        want = WORD.findall(lower(phrase))
        size = min(n, len(want))
        grams = {tuple(want[i:i + size]) for i in range(len(want) - size + 1)} if size else set()
        for i in range(len(words) - size + 1 if size else 0):
            if tuple(words[i:i + size]) in grams:
                hit.update(range(i, i + size))
                found.add(item)
    return len(words), hit, found


ITEMS = [(1, prose(5, 20)), (2, "Short One"), (3, None), (4, ""), (5, prose(5, 20)), (5, prose(5, 20)), (6, prose(6, 13))]


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def contaminated_texts(odd_texts):
    return [*odd_texts, f"{prose(8, 40)} {prose(5, 20).upper()} {prose(9, 40)}", prose(5, 20)[10:] + " short  one!",
            " ".join([prose(6, 13)] * 50), prose(5, 20).replace(" ", "\n"), f"{prose(11, 900)} short one"]


@pytest.mark.parametrize("block", [None, 200])
def test_decontamination(docs, odd_texts, benchmark, block, monkeypatch):
    if block:  # a benchmark larger than one broadcast set takes several passes
        monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    texts = contaminated_texts(odd_texts)
    got = {r["doc_id"]: r for r in decontamination.scan(docs(texts), benchmark).collect()}
    for i, text in enumerate(texts):
        n, hit, found = hit_words(text, ITEMS)
        spans = {w for r in got[i]["hits"] for w in range(r["start"], r["end"])}
        assert (got[i]["n_words"], spans, got[i]["items"]) == (n, hit, sorted(found))


def test_decontamination_drops_documents_or_spans(docs, odd_texts, benchmark):
    texts = contaminated_texts(odd_texts)
    df = docs(texts)
    kept = decontamination.drop_contaminated(df, benchmark)
    assert kept.columns == df.columns
    gone = set(range(len(texts))) - {r["doc_id"] for r in kept.collect()}
    expected = set()
    for i, text in enumerate(texts):
        n, hit, _ = hit_words(text, ITEMS)
        if hit and 20 * len(hit) >= n:
            expected.add(i)
    assert gone == expected and len(texts) - 1 not in gone
    cut = {r["doc_id"]: r["text"] for r in decontamination.without_spans(df, benchmark).collect()}
    assert cut[1] == "" and cut[4] == texts[4] and "short" not in lower(cut[len(texts) - 1])
    assert decontamination.scan(df.limit(0), benchmark).count() == 0
    assert decontamination.scan(df, benchmark.limit(0)).where("size(hits) > 0").count() == 0


@pytest.fixture(scope="module")
def library():
    with open(queries.RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_agrees_with_the_library(docs, odd_texts, library):
    texts = [*odd_texts, "a" * 5000, "don't  stop\n\n now<|endoftext|>", "࢏՘ \U000323b0x", "abababab" * 99]
    rows = {r["doc_id"]: r for r in queries.bpe_digests(docs(texts)).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        assert rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert queries.bpe_digests(docs([])).count() == 0


def test_replay_of_random_words(library):
    ranks = bpe.load_ranks(queries.RANKS)
    coder = bpe.Coder(ranks, public_tokenizers.PATTERN)
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("aeinst h"), 40)) for _ in range(400)]
    got = coder.encode([coder.cut(t.encode()) for t in texts])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library.encode_ordinary(t) for t in texts]


def plain_pii(text):
    shapes = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
              "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, shape in shapes.items():
        for m in re.finditer(shape, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            fits = {"email": lambda: True, "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                    "card": lambda digits=digits, doubled=doubled: 16 <= len(digits) <= 19 and sum(n - 9 * (n > 9) for n in doubled) % 10 == 0,
                    "phone": lambda digits=digits: 8 <= len(digits) <= 15}[kind]()
            if fits:
                out.append((kind, *m.span()))
    return out


PERSONAL = ["mail a.b@c.de, +1 (187) 555-8851 and 10.0.0.7", "é 4532 0151 1283 0366 / 4532015112830366.", "x@y@z.w.v 256.1.1.1 1.2.3.4.5.6.7.8",
            "+1234567 +12345678 a%x@b.c%d@e.f", "call (187) 555-8851", "9" * 3000 + "@" * 50 + "." * 50]


def test_pii_addresses_of_any_length_stay_whole():
    class Every(pii.Field):
        """Takes each candidate of a mail address."""

        def best(self, atoms, segments):
            return [s for s in segments if s[2] == 0]

    local, host = "a" * 300, "h" * 500
    for text in (f"to {local}@{host} now", f"{local}@{host}", f"to {local}@{local}@{host} now"):
        spans = [s[1:3] for s in pii.find(text, Every()) if not s[3]]
        assert spans and all(a == 0 or text[a - 1] in " @" for a, _ in spans)
        assert all(b == len(text) or text[b] in " @" for _, b in spans)


def test_pii_added_spans_meet_no_base_span():
    class Every(pii.Field):
        def best(self, atoms, segments):
            return [(0, len(atoms), 3, None, atoms[0][0])]

    # One long base span that holds many shorter ones of another kind.
    text = "+1 (" + ".".join(["1.2.3.4"] * 2) + ") and a@b.c" + " 77 1.2.3.4" * 9
    found = pii.find(text, Every())
    base = [s for s in found if s[3]]
    assert base and all(y <= a or b <= x for _, a, b, added in found if not added for _, x, y, _ in base)


def test_pii_base_spans(docs, odd_texts):
    texts = [*odd_texts, *PERSONAL]
    rows = {r["doc_id"]: r["spans"] for r in pii.scan(docs(texts)).collect()}
    for i, text in enumerate(texts):
        base = [(s["kind"], s["start"], s["end"]) for s in rows[i] if s["base"]]
        assert base == plain_pii(text or "")
        order = [(pii.KINDS.index(s["kind"]), s["start"]) for s in rows[i]]
        assert order == sorted(order)
    assert pii.scan(docs([])).count() == 0


def test_semi_markov_field():
    field = pii.train([f"x {p} y" for p in PERSONAL] + [f"+1 ({a}) 555-{b}" for a, b in ((200, 1111), (310, 2222))] + ["version 2.0", "in 1999"])
    assert ("phone", 5, 19, False) in pii.find("call (187) 555-8851 now", field)
    assert pii.find("version 2.0.1 of 2024", field) == []
    # The best labelling is the best of all labellings, enumerated.
    atoms, segments = next(pii.regions("1.2.3.4 5551"))
    rng = np.random.default_rng(0)
    field.weights, field.after = rng.normal(size=field.weights.shape), rng.normal(size=field.after.shape)
    outside = len(pii.KINDS)

    def all_of(at):
        if at == len(atoms):
            yield []
            return
        for rest in all_of(at + 1):
            yield [None, *rest]
        for s in segments:
            if s[0] == at:
                for rest in all_of(s[1]):
                    yield [s, *rest]

    def score(labelling):
        total, last = 0.0, outside
        for s in labelling:
            kind = s[2] if s else outside
            total += field.after[last, kind] + (field.weights[kind] @ s[3] if s else 0)
            last = kind
        return total

    every = list(all_of(0))
    best = max(every, key=score)
    assert np.isclose(score(best), max(map(score, every)))
    found = field.best(atoms, segments)
    assert [id(s) for s in found] == [id(s) for s in best if s]
    value = field.gradient(atoms, segments, found)[0]
    assert np.isclose(value, score(best) - np.logaddexp.reduce([score(x) for x in every]))


def plain_secrets(data):
    shapes = [rb"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", rb"AKIA[A-Z0-9]+", rb"[0-9a-f]+"]
    fits = [lambda m: len(m[1]) >= 6, lambda m: len(m[0]) >= 20, lambda m: len(m[0]) >= 24]
    text = data.decode()
    point = lambda b: len(data[:b].decode())
    names = ["assign", "access", "hex"]
    found = [(m.start(), k, m.end()) for k, s in enumerate(shapes) for m in re.finditer(s, data) if fits[k](m)]
    assert text is not None
    return [(names[k], point(a), point(b)) for a, k, b in sorted(found)]


def test_secrets(docs, odd_texts):
    rng = np.random.default_rng(3)
    pieces = ["token", "PASSWD", "api_key", '"', " ", ":", "=", "abc", "AKIA", "ABCDEF0123456789", "deadbeef0123456789abcdef", "é", "ghp_", "-"]
    texts = [*odd_texts, *("".join(rng.choice(pieces, rng.integers(1, 12))) for _ in range(300)), "x -----BEGIN RSA PRIVATE KEY----- y",
             "token=token:abcdef", "0" * 100_000]
    rows = {r["doc_id"]: r["spans"] for r in secret_scan.scan(docs(texts)).collect()}
    for i, text in enumerate(texts):
        base = [(s["kind"], s["start"], s["end"]) for s in rows[i] if s["base"]]
        assert base == plain_secrets((text or "").encode())
    assert [(s["kind"], s["start"]) for s in rows[len(texts) - 3]] == [("private_key", 2)]
    assert secret_scan.scan(docs([])).count() == 0


def test_automaton_is_minimal():
    machine = Automaton([read("a(b|c)*d"), read("ab{2,}d")], anywhere=False)
    state, seen = 0, []
    for byte in b"abbd":
        state = machine.table[state + byte]
        seen.append(machine.rules.get(state, 0))
    assert seen == [0, 0, 0, 3]
    assert Automaton([read("aa|ba")], anywhere=False).states == Automaton([read("[ab]a")], anywhere=False).states


def test_licenses(docs, odd_texts):
    texts = [*odd_texts, "MIT license mit LICENSE, cc by 4. Apache License", "GNU General Public\nLicense GNU general-public license",
             "SPDX-License-Identifier: (GPL-2.0-only WITH Classpath-exception-2.0 OR Apache-2.0) AND MIT", "SPDX-License-Identifier: MIT OR"]
    rows = {r["doc_id"]: r for r in licenses.scan(docs(texts)).collect()}
    for i, text in enumerate(texts):
        words = WORD.findall(lower(text))
        places = sorted((k, label) for phrase, label in licenses.NAMES.items() for k in range(len(words))
                        if words[k:k + len(phrase.split())] == phrase.split())
        assert rows[i]["n_words"] == len(words)
        assert [(p["word"], p["label"]) for p in rows[i]["places"]] == places
        assert rows[i]["base"] == sorted({label for _, label in places}) and set(rows[i]["base"]) <= set(rows[i]["labels"])
        assert 0 <= rows[i]["score"] <= 1
    tagged = rows[len(texts) - 2]
    assert tagged["labels"] == ["apache", "gpl", "mit"] and tagged["permissive"]
    assert rows[len(texts) - 1]["score"] == 0.5
    assert licenses.scan(docs([])).count() == 0


def test_license_expressions():
    def meets(text):
        return licenses.evaluate(text.replace("(", "( ").replace(")", " )").split()).permissive
    assert meets("MIT AND Apache-2.0 OR GPL-3.0") and not meets("MIT AND ( Apache-2.0 AND GPL-3.0 )")
    assert not meets("GPL-2.0 OR GPL-3.0 AND MIT") and meets("(GPL-2.0 OR MIT) AND BSD-3-Clause")
    for broken in ("MIT OR", "( MIT", "MIT )", "OR MIT", "MIT MIT"):
        with pytest.raises(ValueError):
            licenses.evaluate(broken.split())


def test_language_gradients_and_training():
    rng = np.random.default_rng(1)
    net = language.fresh(["a", "b"], 3)
    windows, labels = rng.integers(1, 255, (7, 5)).astype(np.uint8), rng.integers(0, 2, 5)
    _, grads = language.gradients(net, windows, labels)
    for array, grad in zip(net.arrays(), grads, strict=True):
        for at in [tuple(i) for i in np.argwhere(np.abs(grad) > 0.01)[:15]]:
            old, sums = array[at], []
            for step in (1e-2, -1e-2):
                array[at] = old + step
                sums.append(language.gradients(net, windows, labels)[0])
            array[at] = old
            assert abs((sums[0] - sums[1]) / 2e-2 - grad[at]) < 5e-3 + 0.15 * abs(grad[at])


def test_language(docs, odd_texts):
    texts = [prose(i, 40, "abcde") if i % 2 else prose(i, 40, "vwxyz") for i in range(80)] + odd_texts
    langs = ["one" if i % 2 else "two" for i in range(80)] + [None] * len(odd_texts)
    df = docs(texts, langs=langs)
    held = language.held_out()
    rows = language.identify(df, df.where(~held)).select("row.doc_id", "*").withColumn("held", held).collect()
    assert len(rows) == len(texts)
    assert all(r["lang_pred"] == langs[r["doc_id"]] for r in rows if r["doc_id"] < 80)
    assert any(r["held"] for r in rows) and all(0 <= r["score"] <= 1 for r in rows)
    got = {r["doc_id"]: r for r in rows}
    for i in (80, 81, 82, 89, 90):  # null, empty, white space, marks, a digit
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    assert got[84]["score"] == got[85]["score"]
    assert sum(got[3]["positions"].values()) == len(texts[3].encode())
    blank = language.identify(df, df.limit(0)).collect()
    assert {r["lang_pred"] for r in blank} == {"und"}
    assert language.identify(df.limit(0), df).count() == 0
    kept = language.identify(df, df, df.columns).where(language.accepted()).select("row.*")
    assert kept.columns == df.columns and kept.where(F.col("doc_id") < 80).count() == 80


def test_language_learns_from_rare_texts_beside_copies(spark):
    texts = F.when(F.col("id") < 600, F.concat(F.lit("text "), "id")).otherwise("the same text")
    rows = spark.range(60_000).select(F.lit("rare").alias("lang"), texts.alias("text"))
    found = {w for lang, w in language.training_windows(rows) if lang == "rare"}
    assert len({w for w in found if w.startswith(b"text ")}) > 180


def test_every_language_is_learned(docs):
    words = lambda k, i: " ".join("".join(chr(0x4E00 + 7 * k + (i * j + c) % 5) for c in range(4)) for j in range(1, 30))
    texts = [words(k, i) for k in range(70) for i in range(1, 5)]
    df = docs(texts, langs=[f"l{k:02}" for k in range(70) for _ in range(4)])
    told = language.identify(df, df.where("doc_id % 4 > 0"), ["doc_id", "lang"]).select("row.lang", "lang_pred").collect()
    assert {r["lang"] for r in told} == {r["lang_pred"] for r in told} and sum(r[0] == r[1] for r in told) > 270


def test_queries_keep_their_columns(spark, docs, odd_texts, tmp_path):
    docs(odd_texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    columns = {"op1_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated", "op3_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
               "op5_secrets": "doc_id n_assign n_access n_hex base_sha256 spans", "op8_language": "doc_id held_out lang_pred score",
               "op9_licenses": "doc_id n_words n_base first_word last_word base_labels labels score"}
    for name, expected in columns.items():
        df = queries.QUERIES[name](spark, str(tmp_path))
        assert df.columns == expected.split() and df.count() == len(odd_texts)

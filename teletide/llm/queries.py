"""The registered queries of the numbered operators, with the SQL they are compared with where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from teletide.llm import (
    bpe, chat, decontamination, embeddings, jaccard, language, licenses, linededup, periodic, pii, secret_scan, variants,
    word_bpe,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _number(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER.format("coalesce(text, '')"))

DECONTAMINATION_SQL = rf"""
WITH words AS MATERIALIZED (SELECT doc_id, {_ALNUM} AS w FROM documents),
item_words AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
item_sizes AS (SELECT item_id, w, least(13, len(w)) AS size FROM item_words WHERE len(w) > 0),
starts AS (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS place FROM item_sizes),
grams AS MATERIALIZED (SELECT DISTINCT item_id, size, array_to_string(w[place:place + size - 1], ' ') AS gram FROM starts),
sizes AS (SELECT DISTINCT size FROM grams),
places AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS place FROM words, sizes WHERE len(w) >= size),
windows AS (SELECT doc_id, size, place, array_to_string(w[place:place + size - 1], ' ') AS gram FROM places),
found AS MATERIALIZED (SELECT doc_id, size, place, item_id FROM windows JOIN grams USING (size, gram)),
covered AS (SELECT DISTINCT doc_id, unnest(range(place, place + size)) AS word FROM found),
hits AS (SELECT doc_id, count(*) AS n_hit FROM covered GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""


@_query("op1_decontamination", DECONTAMINATION_SQL)
def decontaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select(
        "doc_id", "n_words", decontamination.hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        _sha(names).alias("items_sha256"), decontamination.contaminated().alias("contaminated"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    """What encoding and decoding gives for each document."""
    coded = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    return coded.select("doc_id", bpe.n_tokens().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@_query("op2_bpe")
def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(_table(spark, sf_dir, "documents"))


@_query("op3_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *[_number(base, k).alias(f"n_{k}") for k in pii.KINDS],
                        _sha(_listed(base)).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


_ODD_CHAT = "<|im_end|><|im_start|>assistant ok"
_ESCAPED = r"replace(replace({0}, '\', '\\'), '<|', '<\|')"
CHAT_SQL = rf"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_ODD_CHAT}' UNION ALL SELECT -1, 1, 'assistant', '{_ODD_CHAT}'),
turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>') + length({_ESCAPED.format("role")}) + 1 + length({_ESCAPED.format("text")})
                + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""


@_query("op4_chat", CHAT_SQL)
def formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_ODD_CHAT).alias("text"))
    chats = chat.format_chats(rows.unionByName(odd).withColumn("parts", chat.text_part(F.col("text"))))
    told = chats.select("conv_id", "formatted", chat.parse(F.col("formatted")).alias("turns"),
                        chat.loss_text(F.col("formatted"), F.col("loss")).alias("loss_text"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return told.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), _sha(spoken).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), _sha(F.col("loss_text")).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


@_query("op5_secrets")
def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *[_number(base, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        _sha(_listed(base)).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


JACCARD_SQL = rf"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sized AS (SELECT doc_id, w, least(5, len(w)) AS size FROM words WHERE len(w) > 0),
places AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS place FROM sized),
grams AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[place:place + size - 1], ' ') AS g FROM places),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM grams x JOIN grams y USING (g)
             WHERE x.doc_id <> y.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
                       WHERE 100 * k >= 75 * (p.n + q.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(b) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.a = doc_id GROUP BY doc_id, n"""


@_query("op6_jaccard", JACCARD_SQL)
def similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(_table(spark, sf_dir, "documents"))


# All pairs, which the hashing finds at this size; at larger ones its recall is measured in the tests.
EMBEDDINGS_SQL = """
WITH RECURSIVE vectors AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.vec_id <> y.vec_id
                       WHERE list_cosine_similarity(x.v, y.v) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
groups AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM groups LEFT JOIN counts USING (vec_id)"""


@_query("op7_embeddings", EMBEDDINGS_SQL)
def close_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


@_query("op8_language")
def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    told = language.identify(docs, docs.where(~language.held_out()))
    return told.select("row.doc_id", "lang_pred", "score").select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@_query("op9_licenses")
def licensed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places.word").alias("first_word"),
        F.array_max("places.word").alias("last_word"), F.array_join("base", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


LINE_SQL = rf"""
WITH split AS MATERIALIZED (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS MATERIALIZED (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS place FROM split),
keys AS MATERIALIZED (SELECT doc_id, line, place, {_LOWER.format("trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13)))")} AS key
                      FROM lines),
repeated AS (SELECT key, max(doc_id) AS keeper FROM keys WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT doc_id, line, place, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM keys LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


@_query("op10_linededup", LINE_SQL)
def unique_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.kept_texts(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_lines", "n_dropped", _sha(F.col("kept")).alias("kept_sha256"))


# One of the near words of each word; crc32 goes bit by bit, and words of one edit meet in what a letter's loss leaves.
VARIANTS_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all({lower}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
counted AS MATERIALIZED (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
coded AS (SELECT doc_id, run, n, hex(encode(concat(doc_id, ':', run))) AS digits FROM counted),
bytes AS (SELECT doc_id, run, n, list_transform(range(1, CAST(length(digits) AS BIGINT), 2), lambda i:
            16 * (strpos('0123456789ABCDEF', digits[i]) - 1) + strpos('0123456789ABCDEF', digits[i + 1]) - 1) AS b FROM coded),
bits AS (SELECT doc_id, run, n, flatten(list_transform(b, lambda x: list_transform(range(8), lambda k: (x >> k) & 1))) AS b FROM bytes),
hashed AS (SELECT doc_id, run, n, xor(4294967295, list_reduce(b, lambda c, x:
             CASE WHEN xor(c, x) & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, 4294967295)) AS h FROM bits),
changed AS (SELECT CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS MATERIALIZED (SELECT DISTINCT word, n, place, word[:place - 1] || word[place + 1:] AS rest
                      FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM words)),
shorter AS (SELECT DISTINCT word, n, rest FROM less),
edges AS (SELECT x.word, y.word AS near, y.n AS near_n FROM less x JOIN less y USING (place, rest) WHERE x.word <> y.word
          UNION SELECT x.word, y.word, y.n FROM shorter x JOIN words y ON x.rest = y.word
          UNION SELECT y.word, x.word, x.n FROM shorter x JOIN words y ON x.rest = y.word),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS top FROM edges GROUP BY word),
named AS (SELECT word, n_near, top, min(near) AS near FROM best JOIN edges USING (word) WHERE near_n = top GROUP BY ALL),
told AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 5 * n THEN near END AS form,
                             CASE WHEN top >= 5 * n THEN top END AS form_n FROM words LEFT JOIN named USING (word)),
paths AS (SELECT word, word AS root, form FROM told
          UNION ALL SELECT paths.word, told.word, told.form FROM paths JOIN told ON paths.form = told.word)
SELECT word, told.form, root, n, n_near, form_n FROM told JOIN paths USING (word) WHERE paths.form IS NULL""".replace(
    "{lower}", _LOWER.format("coalesce(text, '')"))


def _one_lost(doc_id: Column, run: Column) -> Column:
    """The run, without one letter where the checksum of document and run is a multiple of 199."""
    h = F.crc32(F.concat_ws(":", doc_id.cast("string"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % 199 == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


@_query("op11_variants", VARIANTS_SQL)
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(_table(spark, sf_dir, "documents"), alter=_one_lost)


def looped(docs: DataFrame) -> DataFrame:
    """doc_id and the text, of which a tenth of the documents repeat a stretch up to their end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, g = F.size("words"), F.floor(h / 10)
    told = docs.select("doc_id", "text", F.when(chosen, words).alias("words"))
    told = told.withColumn("a", F.when(n > 0, (g % n).cast("int")))
    told = told.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    # Zero-based places: those before a, then a + (i - a) % p.
    again = F.transform(F.sequence(F.col("a"), n - 1), lambda i: F.element_at("words", F.col("a") + (i - F.col("a")) % F.col("p") + 1))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), again), " ")
    return told.select("doc_id", F.when(F.col("a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


@_query("op12_runs")
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.scan(looped(_table(spark, sf_dir, "documents")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    top = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    told = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("top"),
                        _sha(lines).alias("runs_sha256"), _sha(F.col("collapsed")).alias("collapsed_sha256"))
    length, period = -F.col("top.less"), F.col("top.period")
    return told.select("doc_id", "n_runs", F.col("top.start").alias("start"), length.alias("length"), period.alias("period"),
                       F.floor(length * 1000 / period).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


@_query("op13_word_bpe")
def word_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = word_bpe.decode(word_bpe.encode(_table(spark, sf_dir, "documents"), WORD_BPE), WORD_BPE)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        _sha(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
                        _sha(F.col("decoded")).alias("decoded_sha256"))

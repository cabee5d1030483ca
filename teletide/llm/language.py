"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from teletide.llm.texts import limit_batches, raw, slices
from teletide.session import materialize_small

# Hidden units of each direction, and bytes that one window holds; the state starts anew in each window.
UNITS, WINDOW = 4, 64
# Training takes about so many documents of each language, and windows of each document.
TRAIN_DOCS, TRAIN_WINDOWS = 250, 8
STEPS, BATCH, RATE = 120, 256, 0.03
# Windows that run side by side, and the languages from which fewer do, since each has scores of its own.
LANES, MANY = 8192, 64
UNKNOWN = "und"


@dataclass
class Network:
    """Weights. Byte 0 fills a window up; both directions share the arrays, the reversed one comes second.

    The gates are piecewise linear: update and reset are clipped to [0, 1], the candidate to [-1, 1].
    """

    languages: list[str]
    embed: np.ndarray  # (3 * UNITS, 2 * 256): what each byte adds to the gates, by direction
    recur: np.ndarray  # (2, 3 * UNITS, UNITS)
    out: np.ndarray  # (languages, 2 * UNITS)
    bias: np.ndarray  # (languages, 1)

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.recur, self.out, self.bias]


def fresh(languages: list[str], units: int, seed: int = 0) -> Network:
    """A network with small random weights."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.3, (3 * units, 512))
    embed[:units] -= 0.3  # slow updates at first
    embed[:2 * units] += 0.5
    return Network(languages, *(a.astype(np.float32) for a in (
        embed, rng.normal(0, 0.4 / units ** 0.5, (2, 3 * units, units)),
        rng.normal(0, 0.3, (len(languages), 2 * units)), np.zeros((len(languages), 1)))))


def both_ways(windows: np.ndarray) -> np.ndarray:
    """Table columns of (steps, 2 * lanes): each window forwards and, in the second half, backwards."""
    return np.concatenate([windows, windows[::-1].astype(np.int64) + 256], axis=1)


def forward(net: Network, columns: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (steps, units, 2 * lanes); ``keep`` gets what training needs of each step."""
    units = net.recur.shape[2]
    steps, lanes = columns.shape[0], columns.shape[1] // 2
    states = np.empty((steps, units, 2 * lanes), np.float32)
    state = np.zeros((units, 2 * lanes), np.float32)
    gates = np.empty((3 * units, 2 * lanes), np.float32)
    moved = np.empty_like(gates)
    fore, back = moved[:, :lanes], moved[:, lanes:]
    a, b = net.recur
    for t in range(steps):
        np.take(net.embed, columns[t], axis=1, out=gates, mode="clip")
        np.matmul(a, state[:, :lanes], out=fore)
        np.matmul(b, state[:, lanes:], out=back)
        gates[:2 * units] += moved[:2 * units]
        open_ = gates[:2 * units]
        if keep is not None:
            raw_gates = open_.copy()
        np.maximum(open_, 0, out=open_)
        np.minimum(open_, 1, out=open_)
        update, reset, pull = gates[:units], gates[units:2 * units], gates[2 * units:]
        if keep is None:
            moved[2 * units:] *= reset
            pull += moved[2 * units:]
        else:
            pull += reset * moved[2 * units:]
            keep.append((raw_gates, update.copy(), reset.copy(), moved[2 * units:].copy(), pull.copy(), state))
        np.maximum(pull, -1, out=pull)
        np.minimum(pull, 1, out=pull)
        after = states[t]
        np.subtract(pull, state, out=after)
        if keep is not None:
            keep[-1] += (after.copy(),)
        after *= update
        after += state
        state = after
    return states


def position_scores(net: Network, states: np.ndarray) -> np.ndarray:
    """Probabilities (languages, steps, lanes) of every position."""
    units, lanes = states.shape[1], states.shape[2] // 2
    scores = np.einsum("lu,sun->lsn", net.out[:, :units], states[:, :, :lanes], optimize=True)
    scores += np.einsum("lu,sun->lsn", net.out[:, units:], states[::-1, :, lanes:], optimize=True)
    scores += net.bias[:, :, None]
    scores -= scores.max(axis=0)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=0)
    return scores


def gradients(net: Network, windows: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy of all positions and its gradients, by backpropagation through time."""
    keep: list = []
    columns = both_ways(windows)
    units, lanes = net.recur.shape[2], windows.shape[1]
    states = forward(net, columns, keep)
    scores = position_scores(net, states)
    real = (windows > 0).astype(np.float32)
    real /= max(real.sum(), 1)
    hit = scores[labels, :, np.arange(lanes)].T
    loss = float(-(np.log(np.maximum(hit, 1e-9)) * real).sum())
    scores[labels, :, np.arange(lanes)] -= 1
    scores *= real
    fore, back = states[:, :, :lanes], states[::-1, :, lanes:]
    d_out = np.concatenate([np.einsum("lsn,sun->lu", scores, fore, optimize=True),
                            np.einsum("lsn,sun->lu", scores, back, optimize=True)], axis=1)
    d_bias = scores.sum(axis=(1, 2))[:, None]
    d_states = np.concatenate([np.einsum("lu,lsn->sun", net.out[:, :units], scores, optimize=True),
                               np.einsum("lu,lsn->sun", net.out[:, units:], scores, optimize=True)[::-1]], axis=2)
    d_embed, d_recur = np.zeros_like(net.embed), np.zeros_like(net.recur)
    carry = np.zeros_like(states[0])
    for t in range(len(keep) - 1, -1, -1):
        raw_gates, update, reset, moved, pull, state, step = keep[t]
        d = d_states[t] + carry
        d_pull = d * update * (np.abs(pull) < 1)
        inside = (raw_gates > 0) & (raw_gates < 1)
        d_gates = np.concatenate([d * step * inside[:units], d_pull * moved * inside[units:], d_pull])
        d_moved = np.concatenate([d_gates[:2 * units], d_pull * reset])
        carry = d * (1 - update)
        for k, half in enumerate((slice(0, lanes), slice(lanes, None))):
            d_recur[k] += d_moved[:, half] @ state[:, half].T
            carry[:, half] += net.recur[k].T @ d_moved[:, half]
        one = np.zeros((columns.shape[1], 512), np.float32)
        one[np.arange(len(one)), columns[t]] = 1
        d_embed += d_gates @ one
    return loss, [d_embed, d_recur, d_out, d_bias]


def cut(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts as columns (window, lanes), and the text that each one belongs to."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = -(-sizes // window)
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.repeat(np.cumsum(sizes) - sizes, counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    flat = np.frombuffer(b"".join(texts) + bytes(window), np.uint8)
    starts = first + offset * window
    rows = flat[starts[:, None] + np.arange(window)]
    rows[np.arange(window) >= (sizes[owner] - offset * window)[:, None]] = 0
    return np.ascontiguousarray(rows.T), owner


def train(samples: list[tuple[str, bytes]], units: int = UNITS, steps: int = STEPS, seed: int = 0) -> Network | None:
    """Fit a network to labelled texts by Adam; None without any."""
    samples = sorted((lang, text) for lang, text in samples if text)
    if not samples:
        return None
    languages = sorted({lang for lang, _ in samples})
    rng = np.random.default_rng(seed)
    windows, owner = cut([text for _, text in samples])
    labels = np.array([languages.index(lang) for lang, _ in samples])[owner]
    members = [np.flatnonzero(labels == k) for k in range(len(languages))]
    net = fresh(languages, units, seed)
    moments = [(np.zeros_like(a), np.zeros_like(a)) for a in net.arrays()]
    steps *= -(-len(members) // MANY)
    for step in range(1, steps + 1):
        turn = members if len(members) <= BATCH else [members[k] for k in rng.permutation(len(members))[:BATCH]]
        pick = np.concatenate([rng.choice(m, max(1, BATCH // len(members))) for m in turn])  # languages alike
        _, grads = gradients(net, windows[:, pick], labels[pick])
        rate = RATE * min(1.0, 2 * (1 - (step - 1) / steps))
        for a, g, (m, v) in zip(net.arrays(), grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return net


def pooled(net: Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: the mean over its positions of each language's probability, and the positions labelled so."""
    windows, owner = cut(texts)
    size, n = len(net.languages), len(texts)
    total, labelled = np.zeros((n, size)), np.zeros((n, size), np.int64)
    side = max(1, LANES * MANY // max(MANY, size))
    for a in range(0, len(owner), side):
        part, lanes = np.ascontiguousarray(windows[:, a:a + side]), owner[a:a + side]
        first, held = lanes[0], lanes[-1] - lanes[0] + 1  # the texts of these windows
        lanes = lanes - first
        scores = position_scores(net, forward(net, both_ways(part)))
        real = part > 0
        best = (scores.argmax(axis=0) + lanes * size)[real]
        labelled[first:first + held] += np.bincount(best, minlength=held * size).reshape(held, size)
        scores *= real
        for k, sums in enumerate(scores.sum(axis=1)):
            total[first:first + held, k] += np.bincount(lanes, sums, held)
    # Byte 0 fills windows up and labels nothing, also where a text holds it; hence the sum, not the length.
    return total / np.maximum(total.sum(axis=1, keepdims=True), 1e-9), labelled


def training_windows(labelled: DataFrame) -> list[tuple[str, bytes]]:
    """A sample of (lang, window) from rows with text and lang, bounded for each language.

    Every language, and about TRAIN_DOCS different texts of each, picked by a hash of the text; TRAIN_WINDOWS
    places of each text, also picked by hash.
    """
    rows = labelled.select("lang", "text").where("lang is not null and text is not null and text <> ''")
    key = F.xxhash64("text")
    # Copies are picked together, so a language's share goes by its different texts, not by its rows.
    counts, small = materialize_small(rows.select("lang", key.alias("key")).distinct().groupBy("lang").count(), "languages")
    picked = F.pmod(key, F.lit(1 << 40)) < F.lit(float(TRAIN_DOCS << 40)) / F.col("count")
    last = F.greatest(F.char_length("text") - (WINDOW - 1), F.lit(1))
    places = F.transform(F.sequence(F.lit(1), F.lit(TRAIN_WINDOWS)),
                         lambda i: F.substr("text", (F.pmod(F.xxhash64("text", i), last) + 1).cast("int"), F.lit(WINDOW)))
    sample = (rows.join(F.broadcast(counts) if small else counts, "lang").where(picked)
              .select("lang", key.alias("key"), places.alias("places")).dropDuplicates(["lang", "key"]).orderBy("key", "lang"))
    return [(r["lang"], place.encode()[:WINDOW]) for r in sample.collect() for place in r["places"]]


def identify(docs: DataFrame, labelled: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The language of each document, told from its bytes alone.

    ``labelled`` has text and lang; a network is fitted to a bounded sample of it (see training_windows) in
    the driver and sent to the tasks. Every byte of every text is labelled. Returns the ``columns`` of
    ``docs`` (doc_id unless named) as struct ``row`` with ``lang_pred``, ``score`` (the mean probability of
    that language over all positions) and ``positions`` (how many positions each language labels). A text
    that is null or has no letter is ``und`` with score 0, and so is every text if nothing is labelled.
    Between equal probabilities the first language by name wins. Repeated rows are told alike; an empty
    table gives no rows.
    """
    net = train(training_windows(labelled))
    keep = columns or ["doc_id"]
    limit_batches(docs.sparkSession)
    # Only the kept columns and the text travel; a kept text does not travel twice.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
                       *([] if "text" in keep else ["text"]))
    column = "row.text" if "text" in keep else "text"
    kind = rows.schema["row"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for piece in slices(batch, column):
                texts = raw(piece, column)
                shares, labelled = pooled(net, texts) if net else (None, None)
                told, score, positions = [], [], []
                for i, text in enumerate(texts):
                    if net is None or not any(map(str.isalpha, text.decode())):
                        told.append(UNKNOWN)
                        score.append(0.0)
                        positions.append([])
                        continue
                    best = int(shares[i].argmax())
                    told.append(net.languages[best])
                    score.append(float(min(1.0, shares[i, best])))
                    positions.append([(net.languages[k], int(labelled[i, k])) for k in np.flatnonzero(labelled[i])])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("row"), pa.array(told, pa.string()), pa.array(score, pa.float64()),
                     pa.array(positions, pa.map_(pa.string(), pa.int64()))], names=["row", "lang_pred", "score", "positions"])
    return rows.mapInArrow(run, f"row {kind}, lang_pred string, score double, positions map<string,bigint>")


def held_out() -> Column:
    """Whether a document is kept from training: crc32 of its doc_id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def accepted(min_score: float = 0.3) -> Column:
    """Whether an identified document has a language that the network does not merely guess."""
    return (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)

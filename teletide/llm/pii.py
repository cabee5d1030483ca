"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds what they miss."""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from teletide.llm.texts import map_texts, plain

KINDS = ("email", "ip", "card", "phone")
# Digit groups that one entity may have, and letters that are stepped back over at once.
MOST_GROUPS, STEP = 8, 64
# Stretches of text that the weights are fitted to, and passes over them.
TRAIN_REGIONS, PASSES = 1500, 60
SPANS = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"

_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
_MARK = re.compile(r"[0-9@]")
_DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses without overlap, found from the @ signs so that no run of letters is tried twice."""
    out, before, part = [], 0, 0  # part: where the letters after the last @ or other break begin
    at = text.find("@")
    while at >= 0:
        start = at
        floor = max(before, part)
        # The local part is everything that may stand in one, back to the break.
        if start > floor:
            tail = re.search(r"[A-Za-z0-9._%+-]*\Z", text[floor:at]) if at - floor <= STEP else None
            start = floor + tail.start() if tail else _back(text, floor, at)
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            out.append((start, domain.end()))
            before = domain.end()
        part = at + 1
        at = text.find("@", max(at + 1, before))
    return out


def _back(text: str, floor: int, at: int) -> int:
    """Where the run of local characters that ends at ``at`` begins, not before ``floor``."""
    start = at
    while start > floor:
        low = max(floor, start - STEP)
        size = len(_LOCAL.match(text[low:start][::-1])[0]) if _LOCAL.match(text[start - 1]) else 0
        start -= size
        if size < start + size - low or not size:
            break
    return start


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of what the fixed patterns find, by kind and place.

    Each kind is matched leftmost and without overlap; a match that fails its test is dropped for good.
    """
    if not _MARK.search(text):
        return []
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if _octets(m[0])]
    out += [("card", *m.span()) for m in _CARD.finditer(text) if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


_NUMBER = re.compile(r"[+(]{0,2}[0-9](?:[\x20().-]{0,3}[0-9])*")


@dataclass
class Region:
    """A stretch of text that may hold entities: its atoms and the candidate segments over them."""

    atoms: list[tuple[int, int]]
    segments: list[tuple[int, int, int, np.ndarray]]  # first atom, atom after the last, label, features


_FEATURES = ("always", "plus", "bracket", "octets", "dotted", "digits_8_15", "digits_10_12", "digits_16_19", "checked",
             "spaced", "one_group", "touches_before", "touches_after", "whole", "few_digits", "local_grouping",
             "mail", "mail_dotted", "mail_ending", "mail_start")
_AT = {name: i for i, name in enumerate(_FEATURES)}


def _vector(**on: bool) -> np.ndarray:
    row = np.zeros(len(_FEATURES))
    row[0] = 1
    for name, value in on.items():
        row[_AT[name]] = value
    return row


def _number_features(text: str, start: int, end: int, whole: bool) -> np.ndarray:
    piece = text[start:end]
    groups = _DIGITS.findall(piece)
    digits = "".join(groups)
    between = set(piece) - set("0123456789")
    return _vector(
        plus=piece[0] == "+", bracket="(" in piece, octets=len(groups) == 4 and between == {"."} and _octets(piece),
        dotted="." in piece, digits_8_15=8 <= len(digits) <= 15, digits_10_12=10 <= len(digits) <= 12,
        digits_16_19=16 <= len(digits) <= 19, checked=16 <= len(digits) <= 19 and luhn(digits),
        spaced=between <= {" ", "-"}, one_group=len(groups) == 1,
        touches_before=start > 0 and text[start - 1].isalnum(), touches_after=end < len(text) and text[end].isalnum(),
        whole=whole, few_digits=len(digits) < 8,
        local_grouping=len(groups) >= 3 and [len(g) for g in groups[-3:]] == [3, 3, 4])


def regions(text: str):
    """The regions of a text: around each number and each @ sign, segments at most MOST_GROUPS atoms long."""
    for number in _NUMBER.finditer(text):
        start, end = number.span()
        groups = [(m.start() + start, m.end() + start) for m in _DIGITS.finditer(number[0])]
        head = groups[0][0] - start  # a plus or bracket in front
        segments = []
        for i in range(len(groups)):
            for j in range(i, min(len(groups), i + MOST_GROUPS)):
                firsts = {groups[i][0], groups[i][0] - (head if i == 0 else 0)}
                if i and text[groups[i][0] - 1] in "+(":
                    firsts.add(groups[i][0] - 1)
                for first in firsts:
                    row = _number_features(text, first, groups[j][1], i == 0 and j == len(groups) - 1)
                    segments += [(i, j + 1, k, row, first) for k in (1, 2, 3)]
        yield groups, segments
    at = text.find("@")
    while at >= 0:
        start = _back(text, 0, at)
        host = _HOST.match(text, at + 1)
        if start < at and host:
            name = host[0]
            row = _vector(mail=True, mail_dotted="." in name, mail_start=text[start].isalnum(),
                          mail_ending=bool(re.search(r"\.[A-Za-z]{2,10}\Z", name)))
            yield [(start, host.end())], [(0, 1, 0, row, start)]
        at = text.find("@", at + 1)


class Field:
    """The random field: weights of segment features by kind, and of one segment's kind after another's.

    A labelling cuts a region's atoms into segments, each an entity of a kind or a single atom outside any,
    and its score is the sum over the segments. Segments are at most MOST_GROUPS atoms long, so the sums
    over all labellings take time linear in the atoms.
    """

    def __init__(self):
        self.weights = np.zeros((len(KINDS), len(_FEATURES)))
        self.weights[:, 0] = -4.0  # unfitted, it finds nothing
        self.after = np.zeros((len(KINDS) + 1, len(KINDS) + 1))  # the last row and column: outside

    def _moves(self, size: int, segments: list) -> list[list[tuple]]:
        outside = len(KINDS)
        moves: list[list[tuple]] = [[(i - 1, outside, 0.0, None)] if i else [] for i in range(size + 1)]
        for s in segments:
            moves[s[1]].append((s[0], s[2], float(self.weights[s[2]] @ s[3]), s))
        return moves

    def best(self, atoms: list, segments: list) -> list[tuple]:
        """The segments of the labelling with the highest score."""
        states = len(KINDS) + 1
        score = np.full((len(atoms) + 1, states), -np.inf)
        score[0, -1] = 0
        trail: dict[tuple[int, int], tuple] = {}
        for i, arriving in enumerate(self._moves(len(atoms), segments)):
            for start, kind, gain, segment in arriving:
                ways = score[start] + self.after[:, kind]
                back = int(ways.argmax())
                if ways[back] + gain > score[i, kind]:
                    score[i, kind] = ways[back] + gain
                    trail[i, kind] = (start, back, segment)
        out, i, kind = [], len(atoms), int(score[-1].argmax())
        while i:
            start, back, segment = trail[i, kind]
            if segment:
                out.append(segment)
            i, kind = start, back
        return out[::-1]

    def gradient(self, atoms: list, segments: list, gold: list) -> tuple[float, np.ndarray, np.ndarray]:
        """Log-likelihood of a labelling and its gradients, by the forward-backward sums."""
        n, states = len(atoms), len(KINDS) + 1
        moves = self._moves(n, segments)
        ahead = np.full((n + 1, states), -np.inf)
        ahead[0, -1] = 0
        for i in range(1, n + 1):
            for start, kind, gain, _ in moves[i]:
                ahead[i, kind] = np.logaddexp(ahead[i, kind], np.logaddexp.reduce(ahead[start] + self.after[:, kind]) + gain)
        behind = np.full((n + 1, states), -np.inf)
        behind[n] = 0
        for i in range(n, 0, -1):
            for start, kind, gain, _ in moves[i]:
                behind[start] = np.logaddexp(behind[start], self.after[:, kind] + gain + behind[i, kind])
        total = np.logaddexp.reduce(ahead[n])
        d_weights, d_after = np.zeros_like(self.weights), np.zeros_like(self.after)
        for i in range(1, n + 1):
            for start, kind, gain, segment in moves[i]:
                share = np.exp(ahead[start] + self.after[:, kind] + gain + behind[i, kind] - total)
                d_after[:, kind] -= share
                if segment:
                    d_weights[kind] -= share.sum() * segment[3]
        value, last, place = -total, states - 1, 0
        ends = {s[0]: s for s in gold}
        while place < n:
            s = ends.get(place)
            kind = s[2] if s else states - 1
            value += self.after[last, kind] + (float(self.weights[kind] @ s[3]) if s else 0.0)
            d_after[last, kind] += 1
            if s:
                d_weights[kind] += s[3]
            last, place = kind, s[1] if s else place + 1
        return value, d_weights, d_after

    def fit(self, examples: list[tuple[tuple, int]], passes: int = PASSES, rate: float = 0.3, decay: float = 1e-3) -> None:
        """Adam on the mean log-likelihood of labelled regions, each with the times it occurs."""
        n = sum(times for _, times in examples)
        moments = [[np.zeros_like(a), np.zeros_like(a)] for a in (self.weights, self.after)]
        for step in range(1, passes + 1):
            sums = [np.zeros_like(self.weights), np.zeros_like(self.after)]
            for example, times in examples:
                for total, part in zip(sums, self.gradient(*example)[1:], strict=True):
                    total += times * part
            for a, g, mv in zip((self.weights, self.after), sums, moments, strict=True):
                g = g / n - decay * a
                mv[0] = 0.9 * mv[0] + 0.1 * g
                mv[1] = 0.99 * mv[1] + 0.01 * g * g
                a += rate * (mv[0] / (1 - 0.9 ** step)) / (np.sqrt(mv[1] / (1 - 0.99 ** step)) + 1e-8)


def labelled_regions(context: str) -> list[tuple[list, list, list]]:
    """The regions of a piece of text, labelled with what the fixed patterns find there."""
    found = {(a, b): KINDS.index(kind) for kind, a, b in base_spans(context)}
    out = []
    for atoms, segments in regions(context):
        gold, upto = [], 0
        for s in segments:
            if found.get((s[4], atoms[s[1] - 1][1])) == s[2] and s[0] >= upto:
                gold.append(s)
                upto = s[1]
        out.append((atoms, segments, gold))
    return out


def variants(context: str) -> list[tuple[list, list, list]]:
    """What the fixed patterns cannot show: a phone number without its country code is one too, and numbers
    that miss a test by little are nothing."""
    out = []

    def add(text: str, kind: int | None = None, start: int = 0, end: int = 0) -> None:
        for atoms, segments in regions(text):
            gold = [s for s in segments if s[2] == kind and (s[4], atoms[s[1] - 1][1]) == (start, end)]
            if gold or kind is None:
                out.append((atoms, segments, gold))

    for kind, a, b in base_spans(context):
        before, piece, after = context[max(0, a - 3):a], context[a:b], context[b:b + 3]
        at = len(before)
        if kind == "phone" and "(" in piece:
            short = piece[piece.index("("):]
            add(before + short + after, 3, at, at + len(short))
            dashed = "-".join(_DIGITS.findall(short))
            add(before + dashed + after, 3, at, at + len(dashed))
        elif kind == "card":
            add(before + piece[:-1] + str((int(piece[-1]) + 1) % 10) + after)
        elif kind == "ip":
            add(before + piece.rsplit(".", 1)[0] + after)
            add(before + piece.rsplit(".", 1)[0] + ".300" + after)
            add(before + piece.split(".", 2)[0] + "." + piece.split(".", 2)[1] + after)
        elif kind == "email":
            add(before + piece[:piece.index(".", piece.index("@"))] + " " + after)
    return out


def train(contexts: list[str]) -> Field:
    """A field fitted to pieces of text."""
    field = Field()
    examples = []
    for context in sorted(contexts):
        examples += labelled_regions(context) + variants(context)
    # A long table of numbers teaches no more than a short one: the fit, not the scan, leaves out regions of over 32 atoms.
    examples = [e for e in examples if len(e[0]) <= 4 * MOST_GROUPS]
    alike = {}  # most regions look the same to the features
    for e in examples:
        key = (len(e[0]), tuple((*s[:3], s[3].tobytes()) for s in e[1]), tuple(i for i, s in enumerate(e[1]) if any(s is g for g in e[2])))
        alike.setdefault(key, [e, 0])[1] += 1
    if any(gold for _, _, gold in examples):
        field.fit(list(alike.values()))
    return field


def find(text: str, field: Field) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base): the base spans and those of the field that overlap none of them."""
    base = base_spans(text)
    out = [(*s, True) for s in base]
    if _MARK.search(text):
        taken = sorted((a, b) for _, a, b in base)
        starts, ends = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
        for atoms, segments in regions(text):
            for s in field.best(atoms, segments):
                a, b = s[4], atoms[s[1] - 1][1]
                near = bisect_left(starts, b)  # base spans that begin before the end
                if not near or ends[near - 1] <= a:
                    out.append((KINDS[s[2]], a, b, False))
    return sorted(set(out), key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def training_regions(docs: DataFrame) -> list[str]:
    """A bounded sample of stretches of text around digits and @ signs: TRAIN_REGIONS, picked by a hash."""
    def make():
        around = re.compile(r".{0,3}[+(]{0,2}[0-9](?:[\x20().-]{0,3}[0-9]){0,40}.{0,3}|[A-Za-z0-9._%+-]{1,64}@.{0,80}")

        def work(batch):
            found = [m[0] for t in plain(batch) if _MARK.search(t) for m in around.finditer(t)]
            return pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["context"])
        return work
    kinds = (F.when(F.contains("context", F.lit("@")), 0).when(F.contains("context", F.lit("+")), 1)
             .when(F.length("context") > 18, 2).otherwise(3))
    contexts = map_texts(docs.select("text").where(F.rlike("text", F.lit("[0-9@]"))), make, "context string").distinct()
    # An equal share of each rough kind, so that rare ones are seen.
    parts = [contexts.where(kinds == k).orderBy(F.xxhash64("context"), "context").limit(TRAIN_REGIONS // 4) for k in range(4)]
    return [r[0] for part in parts for r in part.collect()]


def scan(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """The personal data in each document.

    Returns doc_id and ``spans`` (kind, start, end in code points, base) of every row, by kind in the order
    of KINDS, then start. The base spans are those of the fixed patterns; the field, fitted to a bounded
    sample of the documents' own numbers and addresses unless given, adds spans that overlap no base span.
    A null or empty text has no spans; repeated rows are scanned alike; an empty table gives no rows; other
    columns are not read.
    """
    known = field or train(training_regions(docs))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def make():
        def work(batch):
            spans = [[{"kind": k, "start": a, "end": b, "base": base} for k, a, b, base in find(t, known)] for t in plain(batch)]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, span)], names=["doc_id", "spans"])
        return work
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs.select("doc_id", "text"), make, f"doc_id {kind}, spans {SPANS}")

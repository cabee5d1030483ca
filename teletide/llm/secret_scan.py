"""Secret scans: all rules compiled into one minimal automaton that reads each byte once."""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from teletide.llm.automaton import Automaton, read
from teletide.llm.texts import map_texts, raw

SPANS = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


@dataclass(frozen=True)
class Rule:
    """A kind of secret: what it looks like, and a test of the matched bytes."""

    kind: str
    pattern: str
    test: Callable[[bytes], bool]
    base: bool = False


def _assigned(match: bytes) -> bool:
    """Whether the value of an assignment has six characters or more."""
    at = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
    value = match[at + 1:].lstrip(b" ")
    return len(value) - (value[:1] in (b'"', b"'")) >= 6


def _long(match: bytes, least: int) -> bool:
    return len(match) >= least


def _random(match: bytes, least: int) -> bool:
    """Long enough, and not a word: at least three bits of entropy a byte."""
    text = match.split()[-1]
    return len(text) >= least and -sum(c / len(text) * math.log2(c / len(text)) for c in Counter(text).values()) >= 3


RULES = [
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", _assigned, True),
    Rule("access", r"AKIA[A-Z0-9]+", partial(_long, least=20), True),
    # A whole run of hexadecimal digits. Those of under eight would fail the test as well; that most words do
    # not end a match saves the scan time, and counting no further keeps the automaton small.
    Rule("hex", r"[0-9a-f]{8,}", partial(_long, least=24), True),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", partial(_long, least=1)),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", partial(_long, least=30)),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]+", partial(_random, least=40)),
    Rule("chat_app", r"xox[abprs]-[A-Za-z0-9-]+", partial(_random, least=15)),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/=-]+", partial(_random, least=20)),
]


class Scanner:
    """The rules as one automaton, and for each rule one that reads backwards to where a match began."""

    def __init__(self, rules: list[Rule]):
        trees = [read(r.pattern) for r in rules]
        self.rules = rules
        self.forward = Automaton(trees, anywhere=True)
        self.back = [Automaton([t.reversed()], anywhere=False) for t in trees]
        self.dead = [m.dead() for m in self.back]

    def ends(self, data: bytes) -> dict[int, list[int]]:
        """For each rule the ends of its matches, one for each stretch of bytes at which it matches."""
        table, accepting, state = self.forward.table, self.forward.accepting, 0
        hits = []
        for at, byte in enumerate(data, 1):
            state = table[state + byte]
            if state >= accepting:
                hits.append((at, state))
        out: dict[int, list[int]] = {}
        for at, state in hits:
            mask = self.forward.rules[state]
            while mask:
                rule = (mask & -mask).bit_length() - 1
                mask &= mask - 1
                found = out.setdefault(rule, [])
                if found and found[-1] == at - 1:
                    found[-1] = at
                else:
                    found.append(at)
        return out

    def start(self, rule: int, data: bytes, end: int, least: int) -> int | None:
        """The leftmost place from ``least`` on where a match of the rule that ends at ``end`` begins."""
        machine, state, found = self.back[rule], 0, None
        table, dead = machine.table, self.dead[rule]
        for at in range(end - 1, least - 1, -1):
            state = table[state + data[at]]
            if state in machine.rules:
                found = at
            elif state == dead:
                break
        return found

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes: leftmost, longest and without overlap in each rule, then tested."""
        out = []
        for rule, ends in self.ends(data).items():
            before = 0
            for end in ends:
                start = self.start(rule, data, end, before)
                if start is not None:
                    before = end
                    if self.rules[rule].test(data[start:end]):
                        out.append((start, rule, end))
        return sorted(out)


@functools.lru_cache(maxsize=4)
def compiled(rules: tuple[Rule, ...]) -> Scanner:
    """The automata of a set of rules, built once in the driver; their size depends on the rules alone."""
    return Scanner(list(rules))


def code_points(data: bytes) -> Callable[[int], int]:
    """From offsets in bytes to offsets in code points."""
    if data.isascii():
        return lambda at: at
    before = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
    return lambda at: int(before[at])


def scan(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """The secrets in each document.

    Returns doc_id and ``spans`` (kind, start, end in code points, base) of every row, by start and then by
    the order of the rules. Matches of one rule are leftmost, longest and do not overlap; those that fail
    the rule's test are dropped and not tried again. Rules may overlap each other. A null or empty text has
    no spans; repeated rows are scanned alike; an empty table gives no rows; other columns are not read.

    One pass over the bytes finds where the matches of all rules end. From each end the rule's own automaton
    reads backwards to where the match began, so the work is linear in the text.
    """
    chosen = tuple(RULES if rules is None else rules)
    scanner = compiled(chosen)

    def make():
        def work(batch):
            spans = []
            for data in raw(batch):
                found = scanner.spans(data)
                point = code_points(data) if found else None
                spans.append([{"kind": chosen[k].kind, "start": point(a), "end": point(b), "base": chosen[k].base}
                              for a, k, b in found])
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, ARROW_SPANS)], names=["doc_id", "spans"])
        return work
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs.select("doc_id", "text"), make, f"doc_id {kind}, spans {SPANS}")

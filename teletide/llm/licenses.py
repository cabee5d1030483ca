"""License scans: Aho-Corasick over words for notices and tags, shunting-yard for the expressions of tags."""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from teletide.llm.texts import alnum_words, map_texts, plain

# Phrases that name a license, and its label.
NAMES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Phrases of license notices that tell the license without naming it like that.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "proprietary",
}
# Identifiers of tags by their first words, and the label of each.
IDENTIFIERS = {
    "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "apache": "apache", "mit": "mit", "bsd": "bsd", "mpl": "mpl", "epl": "epl",
    "isc": "isc", "bsl": "bsl", "cc-by": "cc-by", "cc0": "cc0", "unlicense": "public-domain", "licenseref": "proprietary",
}
PERMISSIVE = {"apache", "mit", "bsd", "isc", "bsl", "cc-by", "cc0", "public-domain"}
TAG = "spdx license identifier"

_BINDING = {"or": 1, "and": 2, "with": 3}
_SYMBOL = re.compile(r"[ \t]*(\(|\)|[A-Za-z0-9.+:-]+)")
# How sure each kind of finding is.
_TRUST = {"tag": 1.0, "name": 0.9, "notice": 0.8, "broken": 0.5}


@dataclass(frozen=True)
class Expression:
    """What a license expression comes to."""

    labels: frozenset
    permissive: bool
    text: str


def _label(symbol: str) -> str | None:
    low = symbol.lower()
    return next((IDENTIFIERS[k] for k in sorted(IDENTIFIERS, key=len, reverse=True)
                 if low == k or low.startswith((f"{k}-", f"{k}+", f"{k}."))), None)


def to_postfix(symbols: list[str]) -> list[str]:
    """The shunting-yard: operands and operators in the order they are applied; ValueError if malformed."""
    out, held, operand = [], [], True  # operand: whether one must come next
    for symbol in symbols:
        bind = _BINDING.get(symbol.lower())
        if symbol == "(" or bind is None and symbol != ")":
            if not operand:
                raise ValueError(f"an operator is missing before {symbol!r}")
            if symbol == "(":
                held.append(symbol)
            else:
                out.append(symbol)
                operand = False
            continue
        if operand:
            raise ValueError(f"an identifier is missing before {symbol!r}")
        while held and held[-1] != "(" and (bind is None or _BINDING[held[-1]] >= bind):
            out.append(held.pop())
        if symbol == ")":
            if not held:
                raise ValueError("a parenthesis is not opened")
            held.pop()
        else:
            held.append(symbol.lower())
            operand = True
    if operand or "(" in held:
        raise ValueError("the expression is not complete")
    return out + held[::-1]


def evaluate(symbols: list[str]) -> Expression:
    """Apply the operators: ``or`` leaves a choice, ``and`` binds to both, ``with`` adds an exception."""
    stack: list[Expression] = []
    for symbol in to_postfix(symbols):
        if symbol not in _BINDING:
            label = _label(symbol)
            stack.append(Expression(frozenset([label] if label else []), label in PERMISSIVE, symbol))
            continue
        right, left = stack.pop(), stack.pop()
        text = f"({left.text} {symbol.upper()} {right.text})"
        if symbol == "with":
            stack.append(Expression(left.labels, left.permissive, text))
        else:
            either = left.permissive or right.permissive
            both = left.permissive and right.permissive
            stack.append(Expression(left.labels | right.labels, either if symbol == "or" else both, text))
    return stack[0]


def read_expression(line: str) -> tuple[Expression | None, bool]:
    """The expression that a line starts with, as far as it is well formed.

    Also tells whether nothing was left over that only an expression would have: an operator or parenthesis.
    """
    symbols, at, depth, operand, size = [], 0, 0, True, 0
    while match := _SYMBOL.match(line, at):
        symbol = match[1]
        at = match.end()
        symbols.append(symbol)
        if symbol == "(" or symbol != ")" and symbol.lower() not in _BINDING:
            if not operand:
                break  # plain words after the expression
            depth += symbol == "("
            operand = symbol == "("
        elif operand or symbol == ")" and not depth:
            break
        else:
            depth -= symbol == ")"
            operand = symbol != ")"
        if not operand and not depth:
            size = len(symbols)
    rest = symbols[size:size + 1]
    clean = not rest or not (rest[0] in "()" or rest[0].lower() in _BINDING)
    return (evaluate(symbols[:size]), clean) if size else (None, False)


def _line(text: str, start: int) -> str:
    end = text.find("\n", start)
    return text[start:end if end >= 0 else len(text)]


class Finder:
    """The phrases as one Aho-Corasick automaton over texts of words with single spaces."""

    def __init__(self):
        self.machine = ahocorasick.Automaton()
        phrases = [*((p, "name", v) for p, v in NAMES.items()), *((p, "notice", v) for p, v in NOTICES.items()), (TAG, "tag", "")]
        for phrase, kind, label in phrases:
            self.machine.add_word(f" {phrase} ", (kind, label, len(phrase) + 1, phrase.count(" ") + 1))
        self.machine.make_automaton()
        self.tag = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*", re.IGNORECASE)

    def find(self, text: str) -> dict:
        """What one text has."""
        words = alnum_words(text.encode())
        line = f" {b' '.join(words).decode()} "
        names, notices, tagged = [], [], False
        passed = seen = 0  # words before a place, counted as the places go on
        for end, (kind, label, size, _) in self.machine.iter(line):
            if kind == "tag":
                tagged = True
                continue
            begin = end - size
            seen += line.count(" ", passed, begin) if begin >= passed else -line.count(" ", begin, passed)
            passed = begin
            (names if kind == "name" else notices).append((seen, label))
        found = []
        if tagged:
            found = [read_expression(_line(text, m.end())) for m in self.tag.finditer(text)]
        good = [e for e, _ in found if e]
        base = {label for _, label in names}
        trust = [_TRUST["name"]] * bool(names) + [_TRUST["notice"]] * bool(notices)
        trust += [_TRUST["tag"] if e and whole else _TRUST["broken"] for e, whole in found]
        return {
            "n_words": len(words), "places": sorted(names), "base": sorted(base),
            "labels": sorted(base.union((x for _, x in notices), *(e.labels for e in good))),
            "expressions": [e.text for e in good], "permissive": all(e.permissive for e in good) if good else None,
            "score": max(trust, default=0.0),
        }


SCHEMA = ("n_words long, places array<struct<word:bigint,label:string>>, base array<string>, labels array<string>, "
          "expressions array<string>, permissive boolean, score double")
_PLACES = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))


def scan(docs: DataFrame) -> DataFrame:
    """The licenses that each document tells of.

    Words are lower-cased runs of ASCII letters, digits and non-ASCII characters. Returns doc_id and, for
    every row, n_words, ``places`` (first word and label of every occurrence of a phrase of NAMES), ``base``
    (their labels), ``labels`` (those of notices and of the expressions after SPDX tags too), the tags'
    ``expressions`` with their operators bound, ``permissive`` (whether every expression can be met by
    permissive licenses alone; null without one) and ``score``, the trust in the surest finding, 0 without
    any. A malformed expression counts up to where it is well formed. A null or empty text has no words and
    no findings; repeated rows are scanned alike; an empty table gives no rows; other columns are not read.
    """
    def make():
        finder = Finder()

        def work(batch):
            found = [finder.find(t) for t in plain(batch)]
            column = lambda name, kind: pa.array([f[name] for f in found], kind)
            places = [[{"word": w, "label": x} for w, x in f["places"]] for f in found]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), column("n_words", pa.int64()), pa.array(places, _PLACES),
                 *(column(c, pa.list_(pa.string())) for c in ("base", "labels", "expressions")),
                 column("permissive", pa.bool_()), column("score", pa.float64())],
                names=["doc_id", "n_words", "places", "base", "labels", "expressions", "permissive", "score"])
        return work
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs.select("doc_id", "text"), make, f"doc_id {kind}, {SCHEMA}")

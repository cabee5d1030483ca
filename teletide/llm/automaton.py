"""Regular expressions over bytes as one minimal deterministic automaton."""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass, field

import numpy as np

_REPEAT = re.compile(r"\{(\d+)(,?)\}")


@dataclass
class Node:
    """A syntax tree: ``kind`` is set, seq, alt, plus, opt or empty."""

    kind: str
    parts: list[Node] = field(default_factory=list)
    bytes: frozenset = frozenset()

    def reversed(self) -> Node:
        parts = [p.reversed() for p in self.parts]
        return Node(self.kind, parts[::-1] if self.kind == "seq" else parts, self.bytes)


class _Reader:
    """Reads literals, ``\\x`` escapes, classes, groups, ``(?i:``, ``|`` and the repeats ? * + {n} {n,}."""

    def __init__(self, text: str):
        self.text, self.at, self.fold = text, 0, False

    def peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def branches(self) -> Node:
        out = [self.sequence()]
        while self.peek() == "|":
            self.take()
            out.append(self.sequence())
        return out[0] if len(out) == 1 else Node("alt", out)

    def sequence(self) -> Node:
        out = []
        while self.peek() not in ("", "|", ")"):
            out.append(self.repeated(self.atom()))
        return Node("seq", out)

    def repeated(self, node: Node) -> Node:
        mark = self.peek()
        if mark in ("?", "*", "+") and mark:
            self.take()
            many = node if mark == "?" else Node("plus", [node])
            return many if mark == "+" else Node("opt", [many])
        if count := _REPEAT.match(self.text, self.at):
            self.at = count.end()
            exact = [node] * int(count[1])
            return Node("seq", exact + [Node("opt", [Node("plus", [node])])] if count[2] else exact)
        return node

    def atom(self) -> Node:
        mark = self.take()
        if mark == "(":
            fold = self.fold
            if self.text.startswith("?i:", self.at):
                self.at, self.fold = self.at + 3, True
            inside = self.branches()
            if self.take() != ")":
                raise ValueError(f"unclosed group in {self.text!r}")
            self.fold = fold
            return inside
        if mark == "[":
            return self.charset()
        return self.single(self.code(mark))

    def code(self, mark: str) -> int:
        if mark != "\\":
            return ord(mark)
        mark = self.take()
        if mark == "x":
            self.at += 2
            return int(self.text[self.at - 2:self.at], 16)
        return ord(mark)

    def single(self, code: int) -> Node:
        text = bytes([code])
        return Node("set", bytes=frozenset(text.lower() + text.upper() if self.fold else text))

    def charset(self) -> Node:
        found: set[int] = set()
        while self.peek() != "]":
            low = high = self.code(self.take())
            if self.peek() == "-" and self.text[self.at + 1:self.at + 2] != "]":
                self.take()
                high = self.code(self.take())
            found.update(range(low, high + 1))
        self.take()
        return Node("set", bytes=frozenset(found))


def read(pattern: str) -> Node:
    """The syntax tree of a pattern."""
    reader = _Reader(pattern)
    tree = reader.branches()
    if reader.at != len(pattern):
        raise ValueError(f"cannot read {pattern[reader.at:]!r} in {pattern!r}")
    return tree


class Automaton:
    """Patterns compiled together by subset construction and minimisation.

    ``table[state + byte]`` is the next state, states being multiples of 256 that start at 0. States from
    ``accepting`` on end a match; ``rules[state]`` is the set of patterns that match there, as a bit mask.
    With ``anywhere`` a match may begin at every byte, else only at the first.
    """

    def __init__(self, trees: list[Node], anywhere: bool):
        self.sets: list[tuple[frozenset, int]] = []  # of each NFA state: the bytes it takes, and the next state
        self.free: dict[int, list[int]] = {}  # moves without a byte
        finals = {}
        start = self._state()
        for k, tree in enumerate(trees):
            first, last = self._build(tree)
            self.free.setdefault(start, []).append(first)
            finals[last] = 1 << k
        self._determine(start, finals, anywhere)
        del self.sets, self.free

    @functools.cached_property
    def table(self) -> list[int]:
        """The transitions, spelled out for each byte."""
        objects = [256 * i for i in range(self.states)]  # each number once, not once for each entry
        return [objects[i] for i in self.moves[:, self.kind].ravel().tolist()]

    def dead(self) -> int | None:
        """The state that no match can be reached from, if there is one."""
        stuck = np.flatnonzero((self.moves == np.arange(self.states)[:, None]).all(axis=1)) * 256
        return next((int(s) for s in stuck if int(s) not in self.rules), None)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "table"}

    def _state(self) -> int:
        self.sets.append((frozenset(), -1))
        return len(self.sets) - 1

    def _build(self, node: Node) -> tuple[int, int]:
        first, last = self._state(), self._state()
        if node.kind == "set":
            self.sets[first] = (node.bytes, last)
            return first, last
        if node.kind == "seq":
            at = first
            for part in node.parts:
                a, b = self._build(part)
                self.free.setdefault(at, []).append(a)
                at = b
            self.free.setdefault(at, []).append(last)
            return first, last
        for part in node.parts:
            a, b = self._build(part)
            self.free.setdefault(first, []).append(a)
            self.free.setdefault(b, []).append(last)
            if node.kind == "plus":
                self.free.setdefault(b, []).append(a)
        if node.kind == "opt":
            self.free.setdefault(first, []).append(last)
        return first, last

    def _determine(self, start: int, finals: dict[int, int], anywhere: bool) -> None:
        closed: dict[int, frozenset] = {}

        def closure(state: int) -> frozenset:
            if state not in closed:
                seen, todo = {state}, [state]
                while todo:
                    for to in self.free.get(todo.pop(), ()):
                        if to not in seen:
                            seen.add(to)
                            todo.append(to)
                closed[state] = frozenset(s for s in seen if self.sets[s][0] or s in finals)
            return closed[state]

        # Bytes that no pattern tells apart move alike.
        kinds: dict[tuple, list[int]] = {}
        used = [s for s, _ in self.sets if s]
        distinct = list(dict.fromkeys(used))
        for b in range(256):
            kinds.setdefault(tuple(b in s for s in distinct), []).append(b)
        groups = list(kinds.values())
        begin = closure(start)
        moves: dict[tuple[int, int], frozenset] = {}
        for s, (taken, to) in enumerate(self.sets):
            for k, group in enumerate(groups):
                if group[0] in taken:
                    moves[s, k] = closure(to)
        number, todo, rows = {begin: 0}, [begin], []
        for subset in todo:  # grows as it is walked
            row = []
            for k in range(len(groups)):
                after = frozenset().union(*(moves[s, k] for s in subset if (s, k) in moves))
                if anywhere:
                    after |= begin
                if after not in number:
                    number[after] = len(number)
                    todo.append(after)
                row.append(number[after])
            rows.append(row)
        ends = np.array([sum(finals[s] for s in subset if s in finals) for subset in todo])
        self._minimise(np.array(rows), ends, groups)

    def _minimise(self, rows: np.ndarray, ends: np.ndarray, groups: list[list[int]]) -> None:
        """Merge states that accept alike and move to merged states alike, until nothing splits."""
        label = np.unique(ends, return_inverse=True)[1]
        while True:
            split = np.unique(np.column_stack([label, label[rows]]), axis=0, return_inverse=True)[1].ravel()
            if split.max() == label.max():
                break
            label = split
        size = label.max() + 1
        some = np.zeros(size, np.int64)
        some[label] = np.arange(len(label))  # a state of each merged one
        order = np.argsort((ends[some] > 0) * 2 - (np.arange(size) == label[0]), kind="stable")  # start first, accepting last
        place = np.empty(size, np.int64)
        place[order] = np.arange(size)
        self.moves = place[label[rows[some[order]]]].astype(np.int32)
        self.kind = np.empty(256, np.int64)
        for k, group in enumerate(groups):
            self.kind[group] = k
        self.states = int(size)
        masks = ends[some[order]].tolist()
        self.rules = {256 * i: m for i, m in enumerate(masks) if m}
        self.accepting = 256 * next((i for i, m in enumerate(masks) if m and i), size)
        if masks[0]:
            raise ValueError("a pattern matches the empty text")

"""BPE with word ends by dynamic programming over the prefixes of each word.

Of the tokens a prefix can end with, exactly one is the last token of the prefix's own encoding. It is found from the
left: a suffix automaton over the vocabulary tells which tokens end at the prefix, longest first, and a token is the last
one if it goes with the last token of the prefix before it, that is, if no merge across their border would have
come before the merges that made the two. Following the last tokens back from the whole word gives its encoding.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from teletide.llm.texts import map_texts, plain

# Words and pairs of tokens whose result a task remembers; beyond it the memory starts anew.
KNOWN_WORDS = 500_000
KNOWN_PAIRS = 500_000
# Up to here the character classes, lower case and composition of Python are those of the tokenizers library.
_ALIKE = "˿"
_SYMBOL_BITS = 17


def _byte_letters() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else one from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


@dataclass
class Vocabulary:
    """Tokens with the merge that makes each, and the automaton that finds them, as plain arrays to send to tasks."""

    tokens: list[str]
    rank: list[int]           # of the merge that makes a token, -1 for a single symbol
    left: list[int]
    right: list[int]
    first: list[int]          # the symbol of each byte inside a word, and at its end
    last: list[int]
    special: dict[str, int]
    keys: np.ndarray          # state << _SYMBOL_BITS | symbol, and the state it leads to
    targets: np.ndarray
    ending: list[tuple[int, ...]]  # the state's link, length, token (-1: none) and next state with a token
    pattern: str
    file: str


class _Automaton:
    """A suffix automaton of several strings: every state is a set of substrings that end at the same places."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, symbol: int, q: int) -> int:
        """A state of its own for the substrings of ``q`` that ``p`` leads to by ``symbol``."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = copy
            p = self.link[p]
        return copy

    def add(self, symbols: list[int]) -> None:
        """Add a string."""
        at = 0
        for symbol in symbols:
            q = self.next[at].get(symbol)
            if q is not None:
                at = q if self.length[q] == self.length[at] + 1 else self._split(at, symbol, q)
                continue
            new, p = self._state(self.length[at] + 1, 0, {}), at
            while p >= 0 and symbol not in self.next[p]:
                self.next[p][symbol] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][symbol]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, symbol, q)
            at = new

    def state(self, symbols: list[int]) -> int:
        """The state that a substring leads to."""
        at = 0
        for symbol in symbols:
            at = self.next[at][symbol]
        return at


def _goes_with(a: int, b: int, merges: dict[int, int], rank: list[int], left: list[int], right: list[int],
               limit: int = 1 << 60) -> bool:
    """Whether token ``b`` may follow token ``a``: no merge across their border comes before one that formed them.

    The merges beside the border are undone from the latest on. Two symbols that then meet there would have merged
    if their rank comes before the merge that took one of them away; of equal ranks the left place merges first.
    """
    while True:
        meets = merges.get(a << _SYMBOL_BITS | b)
        if meets is not None and meets < limit:
            return False
        if rank[a] > rank[b]:
            limit, a = rank[a], right[a]
        elif rank[b] >= 0:
            limit, b = rank[b] + 1, left[b]
        else:
            return True


def load(path: str) -> Vocabulary:
    """Read a tokenizer file of the tokenizers library whose model is BPE over byte letters with word ends.

    Tokens that their own merges do not lead to can occur in no encoding and are left out of the automaton.
    """
    with open(path, encoding="utf-8") as lines:
        file = lines.read()
    spec = json.loads(file)
    model = spec["model"]
    split = spec["pre_tokenizer"]["pretokenizers"][0]
    ids, suffix = model["vocab"], model["end_of_word_suffix"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    size = max([*ids.values(), *special.values()]) + 1
    tokens, rank, left, right = [""] * size, [-1] * size, [-1] * size, [-1] * size
    for text, i in [*ids.items(), *special.items()]:
        tokens[i] = text
    merges = {}
    for n, (a, b) in enumerate(model["merges"]):
        i, x, y = ids[a + b], ids[a], ids[b]
        merges[x << _SYMBOL_BITS | y] = n
        rank[i], left[i], right[i] = n, x, y
    letters = _byte_letters()
    first, last = [ids[c] for c in letters], [ids[c + suffix] for c in letters]
    spelled: dict[int, list[int]] = {i: [i] for i in [*first, *last]}
    for i in sorted(ids.values(), key=rank.__getitem__):
        a, b = left[i], right[i]
        if rank[i] >= 0 and a in spelled and b in spelled and _goes_with(a, b, merges, rank, left, right, rank[i]):
            spelled[i] = spelled[a] + spelled[b]
    automaton = _Automaton()
    for symbols in spelled.values():
        automaton.add(symbols)
    of_state = {automaton.state(symbols): i for i, symbols in spelled.items()}
    keys, targets = [], []
    for s, following in enumerate(automaton.next):
        for symbol, t in following.items():
            keys.append(s << _SYMBOL_BITS | symbol)
            targets.append(t)
    nearest = [0] * len(automaton.link)  # the longest token that is a shorter suffix; 0, the root, ends the chain
    for s in sorted(range(1, len(automaton.link)), key=automaton.length.__getitem__):
        up = automaton.link[s]
        nearest[s] = up if up in of_state else nearest[up]
    ending = [(automaton.link[s], automaton.length[s], of_state.get(s, -1), nearest[s]) for s in range(len(automaton.link))]
    return Vocabulary(tokens, rank, left, right, first, last, special, np.array(keys, np.int64), np.array(targets, np.int64),
                      ending, split["pattern"]["Regex"], file)


class Encoder(dict):
    """The token ids of words, as little-endian 32-bit integers; remembers the words it has met."""

    def __init__(self, v: Vocabulary):
        super().__init__()
        self.v, self.pairs = v, {}
        self.steps = dict(zip(v.keys.tolist(), v.targets.tolist(), strict=True))
        self.merges = {a << _SYMBOL_BITS | b: n for n, a, b in zip(v.rank, v.left, v.right, strict=True) if n >= 0}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        v, text = self.v, word.encode()
        found = [v.special[word]] if word in v.special else self.encode([*[v.first[b] for b in text[:-1]], v.last[text[-1]]])
        self[word] = out = np.array(found, "<i4").tobytes()
        return out

    def _together(self, a: int, b: int) -> bool:
        key = a << _SYMBOL_BITS | b
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= KNOWN_PAIRS:
                self.pairs.clear()
            v = self.v
            found = self.pairs[key] = _goes_with(a, b, self.merges, v.rank, v.left, v.right)
        return found

    def encode(self, symbols: list[int]) -> list[int]:
        """The tokens of one word, given as symbols."""
        steps, ending = self.steps, self.v.ending
        lasts, sizes = [-1], [0]  # the last token of every prefix and how many symbols it has
        state = held = 0
        for k, symbol in enumerate(symbols, 1):
            while (to := steps.get(state << _SYMBOL_BITS | symbol)) is None:
                state = ending[state][0]
                held = ending[state][1]
            state, held = to, held + 1
            # The whole state is a suffix only if as many symbols were matched.
            at = state if held == ending[state][1] and ending[state][2] >= 0 else ending[state][3]
            while True:
                _, size, token, shorter = ending[at]
                if size == k or self._together(lasts[k - size], token):
                    lasts.append(token)
                    sizes.append(size)
                    break
                at = shorter
        out, k = [], len(symbols)
        while k:
            out.append(lasts[k])
            k -= sizes[k]
        return out[::-1]


class Words:
    """Cuts a text into the words and special tokens that the tokenizers library sees.

    Texts up to U+02FF are lower-cased and cut with Python's own means, which agree with the library there; of others
    the library's normalizer and splitter are used, as its tables may be of another version of Unicode.
    """

    def __init__(self, v: Vocabulary):
        self.find = regex.compile(v.pattern).findall
        # A special token is matched as it stands, before anything is normalized, and in no other case.
        self.special = regex.compile("(" + "|".join(map(regex.escape, v.special)) + ")").split if v.special else None
        self.file, self.library = v.file, None

    def __call__(self, text: str) -> list[str]:
        if self.special is None or "<" not in text:
            return self._words(text)
        parts = self.special(text)
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else self._words(part))]

    def _words(self, text: str) -> list[str]:
        if text.isascii() or max(text) <= _ALIKE:
            return self.find(text.lower())
        if self.library is None:
            spec = json.loads(self.file)
            spec["pre_tokenizer"] = spec["pre_tokenizer"]["pretokenizers"][0]  # without the byte letters
            self.library = Tokenizer.from_str(json.dumps(spec))
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Each document's token ids as the tokenizers library gives them without special tokens added.

    Returns doc_id and ``ids`` (array of int) for every row. A null or empty text, or one without a word, has no ids.
    The names of special tokens in a text are those tokens, as the library has it. Repeated rows are encoded alike,
    other columns are not read, an empty table gives no rows. ``path`` is the tokenizer file, read in the driver;
    its automaton, as large as the vocabulary whatever the corpus, is sent to the tasks, and a task encodes each
    word it has not met. A text beyond U+02FF is cut by the library's own means; a very long
    word takes time in proportion to its length. Nothing is shuffled.
    """
    v = load(path)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        coder, words = Encoder(v), Words(v)

        def work(batch):
            coded = [b"".join(map(coder.__getitem__, words(t))) for t in plain(batch)]
            edges = np.cumsum([0, *(len(c) // 4 for c in coded)])
            ids = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(np.frombuffer(b"".join(coded), "<i4"), pa.int32()))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "ids"])
        return work
    return map_texts(docs.select("doc_id", "text"), make, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The text of token ids as the library gives it with special tokens kept: doc_id, ids and ``decoded``.

    The file names no decoder, so the tokens are joined by one space, word ends and byte letters included. Null ids
    give an empty text; an id that the vocabulary does not have is an error.
    """
    tokens = load(path).tokens
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def make():
        def work(batch):
            ids = batch.column("ids")
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            if len(flat) and flat.min() < 0:
                raise IndexError(f"the vocabulary has no id {flat.min()}")
            ends = np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)).tolist()
            texts = [" ".join(map(tokens.__getitem__, flat[a:b].tolist())) for a, b in zip([0, *ends], ends, strict=False)]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(texts, pa.string())],
                                              names=["doc_id", "ids", "decoded"])
        return work
    return map_texts(encoded.select("doc_id", "ids"), make, f"doc_id {kind}, ids array<int>, decoded string", "ids")

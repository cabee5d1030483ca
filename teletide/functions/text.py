"""Full-text terms and regular expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Everything that is neither a letter nor a digit separates terms.
SEPARATOR = r"[^\p{L}\p{N}]+"


def query_terms(query: str) -> list[str]:
    """Distinct lower-case terms of a search text."""
    terms = "".join(c if c.isalnum() else " " for c in query.lower()).split()
    return list(dict.fromkeys(terms))


def matches(text: Column, query: str) -> Column:
    """True when every term of ``query`` occurs in ``text``, ignoring case.

    A plain substring test runs first, so that only rows that can match are split into terms.
    """
    terms = query_terms(query)
    if not terms:
        return F.lit(True)
    lowered = F.lower(text)
    found = F.lit(True)
    for term in terms:
        found = found & F.contains(lowered, F.lit(term))
    tokens = F.split(lowered, SEPARATOR)
    for term in terms:
        found = found & F.array_contains(tokens, term)
    return found


# Constructs Java's engine accepts but RE2 does not.
_NOT_RE2 = [
    (r"\(\?[=!]|\(\?<[=!]", "lookaround"),
    (r"\\[1-9]|\\k<", "backreference"),
    (r"\(\?>", "atomic group"),
    (r"[*+?}]\+", "possessive quantifier"),
]


def regex(text: Column, pattern: str) -> Column:
    """Unanchored RE2-style match."""
    bare = re.sub(r"\\[^1-9k]", "_", pattern)  # an escaped sign is plain
    for construct, name in _NOT_RE2:
        if re.search(construct, bare):
            raise ValueError(f"{name} is not allowed in a pattern: {pattern!r}")
    # Only a newline ends a line, and a final $ is the end of the text, not a place before a newline.
    end = re.search(r"(?<!\\)(?:\\\\)*\$\Z", pattern) and not re.search(r"\(\?[a-z]*m", pattern)
    body = pattern[:-1] + r"\z" if end else pattern
    return text.rlike("(?d)" + body.replace("(?P<", "(?<"))

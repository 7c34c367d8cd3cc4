"""Secrets in texts: patterns that stand for themselves, and weak candidates that count only beside their complement.

An access identifier, a secret key and an endpoint are parts of one credential. Each weak candidate is an interval; it is
joined with the intervals of complementary parts that lie within ``REACH`` characters of it in the same scope (a paragraph).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable
from itertools import accumulate
from math import log2

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from loomstar.llm.tables import prepare

# The patterns, and the least length of what they must give.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
#: Weak candidates: identifiers of other kinds, bare keys, endpoints.
WEAK_ID = re.compile(r"\b(?:ASIA|AROA|AIDA|AGPA|ANPA)[A-Z0-9]{12,}\b|\b(?:client|account|user|access)[_-]?id\x20*[:=]\x20*[\w.@-]{4,}", re.ASCII | re.IGNORECASE)
# Runs are taken whole, from their first character on and without going back, so no text takes more than linear time.
WEAK_KEY = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{32,}+={0,2}+(?![A-Za-z0-9+/=_-])")
WEAK_URL = re.compile(r"(?<![a-z0-9+.-])[a-z0-9+.-]++://[^\s\"'<>]++", re.ASCII | re.IGNORECASE)
WEAK_ADDRESS = re.compile(r"\b\d{1,3}(?:\.\d{1,3}){3}:\d{2,5}\b", re.ASCII)
#: Labels near the end of a host's name that tell a service's endpoint.
SERVICE = re.compile(r"\.(?:amazonaws|windows|googleapis|database|internal|local)(?![a-z0-9-])", re.ASCII | re.IGNORECASE)
_HOST = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789.-")
_HOST_END = re.compile(r"(?:\.[a-z]{2,}+)*+(?![a-z0-9])", re.ASCII | re.IGNORECASE)
_PORT = re.compile(r":\d+", re.ASCII)
_FIRST_LETTER = re.compile(r"\b[a-z]", re.ASCII | re.IGNORECASE)
#: Bits per character that a bare key must have, and how far apart parts of one credential may lie.
ENTROPY, REACH = 3.5, 300
SCOPE = re.compile(r"\n[ \t\r]*\n")

#: Kinds in the order in which spans with one start are listed; the first three are the base.
KINDS = ("assign", "access", "hex", "id", "key", "endpoint")
#: What each kind is a part of a credential as.
PART = {"assign": "secret", "access": "identifier", "hex": "secret", "id": "identifier", "key": "secret", "endpoint": "endpoint"}

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Leftmost, non-overlapping matches of each kind; too short ones are dropped after they took their place."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED] if ":" in text or "=" in text else []
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return found + [(m.start(), m.end(), "hex") for m in _LONG_HEX.finditer(text)]


#: A run of hexadecimal digits is matched from its first one, so asking for the length at once gives the same runs.
_LONG_HEX = re.compile(rf"[0-9a-f]{{{LEAST_HEX},}}")


def entropy(text: str) -> float:
    return -sum(p * log2(p) for p in (text.count(c) / len(text) for c in set(text)))


class Ends:
    """Intervals by start, with the greatest end of all up to each: whether any meets a place is one search."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        ordered = sorted(spans)
        self.starts = [a for a, _ in ordered]
        self.most = list(accumulate((b for _, b in ordered), max))

    def meet(self, first: int, last: int) -> bool:
        """Whether an interval starts before ``last`` and ends after ``first``."""
        at = bisect_left(self.starts, last)
        return at > 0 and self.most[at - 1] > first


def endpoints(text: str) -> list[Span]:
    """URLs, hosts of known services with their ports, and numeric addresses with a port; what lies inside an earlier kind is left out."""
    found = []
    if "://" in text:
        for m in WEAK_URL.finditer(text):
            first = _FIRST_LETTER.search(text, m.start(), text.index("://", m.start()))
            if first:
                found.append((first.start(), m.end()))
    for kind in (_hosts(text), ((m.start(), m.end()) for m in WEAK_ADDRESS.finditer(text)) if "." in text and ":" in text else ()):
        taken = Ends(found)
        found += [(a, b) for a, b in kind if not taken.meet(a, b)]
    return [(a, b, "endpoint") for a, b in found]


def _hosts(text: str) -> list[tuple[int, int]]:
    """From the last service label of a run of host characters back to the run's start, and on over labels of letters and a port."""
    out, begun, label = [], 0, None

    def close() -> None:
        if label is not None and label[0] > begun:
            rest = _HOST_END.match(text, label[1])
            stop = rest.end() if rest else label[1]
            port = _PORT.match(text, stop)
            out.append((begun, port.end() if port else stop))

    done = 0  # what lies before is read
    for m in SERVICE.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _HOST:
            start -= 1
        if start > done or label is None:
            close()
            begun = start
            while begun < m.start() and text[begun] in ".-":
                begun += 1
        label, done = (m.start(), m.end()), m.end()
    close()
    return out


def weak_candidates(text: str, base: list[Span]) -> list[Span]:
    """Candidates that do not overlap a base span or, being keys, an identifier or endpoint."""
    found = endpoints(text)
    found += [(m.start(), m.end(), "id") for m in WEAK_ID.finditer(text)]
    fixed, taken = Ends(s[:2] for s in base), Ends(s[:2] for s in base + found)
    found = [s for s in found if not fixed.meet(s[0], s[1])]
    for m in WEAK_KEY.finditer(text):
        if not taken.meet(m.start(), m.end()) and any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0]) and entropy(m[0]) >= ENTROPY:
            found.append((m.start(), m.end(), "key"))
    return found


#: What a part needs beside it.
NEEDS = {"identifier": ("secret",), "secret": ("identifier",), "endpoint": ("identifier", "secret")}


def linked(text: str, base: list[Span], weak: list[Span], reach: int = REACH) -> list[Span]:
    """Weak candidates with a complementary part in their scope and reach: an identifier or key needs the other, an endpoint either.

    A join of intervals: of a scope's parts of one kind that start early enough, the one that ends last is near enough or none is.
    """
    cuts = [m.start() for m in SCOPE.finditer(text)]
    by_part: dict[tuple[int, str], list[tuple[int, int]]] = {}
    for start, end, kind in base + weak:
        by_part.setdefault((bisect_left(cuts, start), PART[kind]), []).append((start, end))
    ends = {part: Ends(spans) for part, spans in by_part.items()}

    def near(scope: int, need: str, start: int, end: int) -> bool:
        return (scope, need) in ends and ends[scope, need].meet(start - reach - 1, end + reach + 1)

    return [s for s in weak if any(near(bisect_left(cuts, s[0]), need, s[0], s[1]) for need in NEEDS[PART[s[2]]])]


def scan(text) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans) of a text; null is empty."""
    if not isinstance(text, str) or not text:
        return [], []
    base = base_spans(text)
    weak = weak_candidates(text, base)
    return base, linked(text, base, weak) if weak else []


def find_secrets(docs: DataFrame, text: Column) -> Column:
    """An array of (kind, start, stop, base) for each row, by start, then kind; positions are code points, end exclusive.

    A null or empty text has none. Texts of any length are scanned whole, in linear time. Repeated rows get equal results, an
    empty table gives no rows, spans of one start are listed by kind, and no other column is read.
    """
    prepare(docs.sparkSession)

    @F.pandas_udf("array<struct<kind: string, start: long, stop: long, base: boolean>>")
    def find(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            base, added = scan(text)
            spans = [(s, KINDS.index(k), e, True) for s, e, k in base] + [(s, KINDS.index(k), e, False) for s, e, k in added]
            out.append([(KINDS[k], s, e, b) for s, k, e, b in sorted(spans)])
        return pd.Series(out)

    return find(text)

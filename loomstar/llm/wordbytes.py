"""Words and their 64-bit hashes of many texts at once, in numpy over UTF-8 bytes.

A word is a run of bytes for which ``word`` of a :class:`Rule` is true. All bytes of a multi-byte
character are 0x80 or more, so a rule over bytes below 0x80 is the same rule over characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Bytes that are hashed in one go; a longer text is worked through in pieces that end between words.
PIECE = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@dataclass(frozen=True)
class Rule:
    word: np.ndarray  # bool[256]
    fold: np.ndarray  # uint8[256], applied before hashing


def rule(is_word, fold_case: bool = True) -> Rule:
    fold = np.arange(256, dtype=np.uint8)
    if fold_case:
        fold[65:91] += 32
    return Rule(np.array([bool(is_word(b)) for b in range(256)]), fold)


#: ``[^\x20\x09-\x0D]+`` after A-Z became a-z.
SPACED = rule(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z.
ALNUM = rule(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= (b + 32 if 65 <= b <= 90 else b) <= 0x7A)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers: list[np.ndarray] = []
#: Longer words are hashed one by one: sums of powers modulo 2^64 give one value to some pairs of words of 1,024 bytes and more.
LONG_WORD = 128


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n + 1:
        size = max(n, 2 * PIECE) + 1
        made = []
        for base in (_BASE, _BASE_INVERSE):
            powers = np.full(size, base, np.uint64)
            powers[0] = 1
            made.append(np.cumprod(powers, dtype=np.uint64))
        if size > 4 * PIECE:
            return made[0], made[1]  # one giant word: not worth keeping
        _powers[:] = made
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of one buffer: where each starts and ends, and its hash."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def _piece_words(piece: np.ndarray, use: Rule, split=None) -> Words:
    inside = use.word[piece]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    if split is not None:  # a cut ends one word and starts the next
        edge = np.sort(np.concatenate([edge, np.repeat(split(piece), 2)]))
    start, end = edge[::2], edge[1::2]
    power, inverse = _powers_to(len(piece))
    sums = np.zeros(len(piece) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[use.fold[piece]] * power[: len(piece)], out=sums[1:])
    value = (sums[end] - sums[start]) * inverse[start]
    value = mixed(value ^ (end - start).astype(np.uint64))
    for i in np.flatnonzero(end - start > LONG_WORD).tolist():
        value[i] = int.from_bytes(hashlib.blake2b(use.fold[piece[start[i] : end[i]]].tobytes(), digest_size=8).digest(), "little")
    return Words(start, end, value)


def words(buffer: np.ndarray, use: Rule, split=None) -> Words:
    """All words of ``buffer`` (uint8). ``split`` gives, for a piece, positions inside words where they are cut."""
    if len(buffer) <= PIECE:
        return _piece_words(buffer, use, split)
    parts, at = [], 0
    while at < len(buffer):
        stop = min(at + PIECE, len(buffer))
        while stop < len(buffer):  # on to the next byte between words
            gap = np.flatnonzero(~use.word[buffer[stop : stop + PIECE]])
            if len(gap):
                stop += int(gap[0])
                break
            stop = min(stop + PIECE, len(buffer))
        found = _piece_words(buffer[at:stop], use, split)
        parts.append(Words(found.start + at, found.end + at, found.hash))
        at = stop
    return Words(*(np.concatenate([getattr(p, k) for p in parts]) for k in ("start", "end", "hash")))


def groups(texts: list, most_bytes: int = PIECE) -> Iterator[tuple[int, list[bytes]]]:
    """(position of the first, encoded texts) in groups of about ``most_bytes``; a longer text is a group of its own. Null is empty."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        if held and size + len(raw) > most_bytes:
            yield first, held
            first, held, size = i, [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield first, held


@dataclass
class Batch:
    """Words of a group of texts; words of text i are ``bounds[i]:bounds[i + 1]``."""

    buffer: np.ndarray
    offsets: np.ndarray
    words: Words
    bounds: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def batch_words(texts: list[bytes], use: Rule) -> Batch:
    """Words of encoded texts, which are joined with a line end (never part of a word)."""
    buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    found = words(buffer, use)
    return Batch(buffer, offsets, found, np.searchsorted(found.start, offsets))


def shingle_hashes(batch: Batch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every run of ``size`` words; a text of fewer words, but not none, is one run. Not yet distinct."""
    value, count = batch.words.hash, np.diff(batch.bounds)
    factor = mixed(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    n = max(len(value) - size + 1, 0)
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total += value[j : j + n] * factor[j]
    doc = batch.doc
    inside = doc[:n] == doc[size - 1 :][:n] if n else np.zeros(0, bool)
    short = np.flatnonzero((count > 0) & (count < size))
    extra = np.zeros(len(short), np.uint64)
    for j in range(size - 1):
        has = count[short] > j
        extra[has] += value[batch.bounds[short[has]] + j] * factor[j]
    extra += count[short].astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)
    return np.concatenate([mixed(total[inside]), mixed(extra)]), np.concatenate([doc[:n][inside], short])

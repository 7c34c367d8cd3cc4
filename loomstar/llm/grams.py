"""Hashed character n-grams of many texts at once, in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

#: Characters worked on at once. A longer text is cut between words (inside one only if it is longer still).
SLICE = 1 << 18
_GAP = re.compile(r"[\W\d_]")
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """bool per code point: whether it is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def slices(texts: list) -> Iterator[list[tuple[int, str]]]:
    """Groups of (text number, part of it) of about ``SLICE`` characters; null is empty."""
    held, size = [], 0
    for i, text in enumerate(texts):
        text = text if isinstance(text, str) else ""
        at = 0
        while at < len(text) or not at:
            stop = at + SLICE
            if stop < len(text):
                gap = _GAP.search(text, stop, stop + SLICE)
                stop = gap.start() if gap else stop + SLICE
            part = text[at:stop]
            if held and size + len(part) > SLICE:
                yield held
                held, size = [], 0
            held.append((i, part))
            size += len(part)
            at = max(stop, 1)
    if held:
        yield held


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def word_grams(texts: list, sizes: tuple[int, ...], buckets: int) -> np.ndarray:
    """float32[texts, buckets]: counts of the n-grams inside lower-cased words, which begin and end with a boundary."""
    out, letters = np.zeros((len(texts), buckets), np.float32), letter_table()
    shift = np.uint32(32 - int(buckets - 1).bit_length())
    for group in slices(texts):
        value = codes("".join(f" {part.lower()} " for _, part in group))
        inside = letters[value]
        value = np.where(inside, value, np.uint32(32))
        doc = np.repeat([k for k in range(len(group))], [len(part.lower()) + 2 for _, part in group])
        keep = inside.copy()
        keep[1:] |= ~inside[1:] & (inside[:-1] | (doc[1:] != doc[:-1]))
        keep[:1] = True
        value, inside, doc = value[keep], inside[keep], doc[keep]
        bounds = np.searchsorted(doc, np.arange(len(group) + 1))
        for size in sizes:
            n = max(len(value) - size + 1, 0)
            mixed = np.full(n, size * 0x632BE5AB & 0xFFFFFFFF, np.uint32)
            for j in range(size):
                mixed = (mixed ^ value[j : j + n]) * _MIX[j]
                mixed ^= mixed >> np.uint32(15)
            valid = inside[:n] | inside[1 : n + 1] if size > 1 else inside[:n]
            for j in range(1, size - 1):
                valid = valid & inside[j : j + n]
            _count(out, group, (mixed * np.uint32(0x9E3779B1)) >> shift, valid, bounds)
    return out


def text_grams(texts: list, sizes: tuple[int, ...], buckets: int) -> np.ndarray:
    """float32[texts, buckets]: counts of the n-grams of all characters as they stand."""
    out = np.zeros((len(texts), buckets), np.float32)
    shift = np.uint32(32 - int(buckets - 1).bit_length())
    for group in slices(texts):
        value = codes("".join(part for _, part in group))
        length = [len(part) for _, part in group]
        bounds = np.concatenate([[0], np.cumsum(length)])
        last = np.repeat(bounds[1:], length)
        for size in sizes:
            n = max(len(value) - size + 1, 0)
            mixed = np.full(n, size * 0x632BE5AB & 0xFFFFFFFF, np.uint32)
            for j in range(size):
                mixed = (mixed ^ value[j : j + n]) * _MIX[j]
                mixed ^= mixed >> np.uint32(15)
            _count(out, group, (mixed * np.uint32(0x9E3779B1)) >> shift, np.arange(n) + size <= last[:n], bounds)
    return out


def _count(out: np.ndarray, group: list[tuple[int, str]], bucket: np.ndarray, valid: np.ndarray, bounds: np.ndarray) -> None:
    for k, (i, _) in enumerate(group):
        a, b = bounds[k], min(bounds[k + 1], len(bucket))
        if a < b:
            out[i] += np.bincount(bucket[a:b][valid[a:b]], minlength=out.shape[1])

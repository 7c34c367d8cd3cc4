"""Stretches of words that repeat with a period: every run, found on a harmonic grid and extended through a grammar.

A run of period q and at least ``max(LEAST, CUBE * q)`` words has that many less q places that agree with the place q
further on. A grid of that spacing, one for each period, so meets every run; grids of all periods have n log n places. Where
a place of a grid agrees, the extensions to both sides are asked of the texts' grammar, which gives the whole run.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from loomstar.llm.grammar import Grammar
from loomstar.llm.tables import column, free_names, prepare

#: A run has at least so many words, and so many times its period.
LEAST, CUBE = 24, 3
#: Words whose grammar is built at once; a longer text is worked on by itself.
WORDS = 1 << 16
_WORD = re.compile("[^\x20\x09-\x0D]+")

RESULT = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def find_runs(texts: list[list[str]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each list of words, by start, then period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    size = np.array([len(texts[i]) for i in order], np.int64)
    base = np.cumsum(np.append(np.int64(1), size + 1))  # each text lies behind a stop
    number = defaultdict(count().__next__)
    value = np.zeros(int(base[-1]), np.int64)
    for k, i in enumerate(order):
        value[base[k] : base[k] + size[k]] = np.fromiter(map(number.__getitem__, texts[i]), np.int64, size[k])
    stops = np.zeros(len(value), bool)
    stops[0] = stops[base[1:] - 1] = True
    value[stops] = len(number) + np.arange(np.count_nonzero(stops))
    found, periods = [], []
    for q in range(1, int(size.max(initial=0)) // CUBE + 1):
        least = max(LEAST, CUBE * q)
        long_enough = int(np.searchsorted(-size, -least, "right"))
        if not long_enough:
            break
        end, step = int(base[long_enough]), least - q
        at = np.flatnonzero(value[: end - q : step] == value[q:end:step])
        if len(at):
            found.append(at * step)
            periods.append(np.full(len(at), q))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not found:
        return out
    place, period = np.concatenate(found), np.concatenate(periods)
    grammar = Grammar(value, stops)
    ahead = grammar.extend(place, place + period)
    behind = grammar.extend(place, place + period, back=True)
    start, length = place - behind, behind + ahead + period
    is_run = length >= np.maximum(LEAST, CUBE * period)
    # the smallest period of a stretch is that of the run; its multiples give the same stretch
    rows = np.unique(np.stack([start[is_run], length[is_run], period[is_run]], axis=1), axis=0)
    first = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))[: len(rows)]
    rows = rows[first]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    which = np.searchsorted(base, rows[:, 0], "right") - 1
    for k, (a, n, q) in zip(which.tolist(), rows.tolist()):
        out[order[k]].append((a - int(base[k]), n, q))
    return out


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words, of each run its first period only, joined by one space."""
    if not runs:
        return " ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return " ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def _groups(texts: list[list[str]]) -> Iterator[list[list[str]]]:
    held, size = [], 0
    for words in texts:
        if held and size + len(words) > WORDS:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def periodic_runs(docs: DataFrame, text: Column) -> Column:
    """A struct for each row of ``docs``: n_words, runs (start, length, period, in words; by start, then period), collapsed.

    A run is a stretch of words that repeats with a smallest period, has at least 24 words and three periods, and cannot go
    on to either side with that period; runs may overlap. ``collapsed`` is the text with each run cut to its first period, its
    words joined by one space. A null, empty or blank text has no words, no runs, and an empty rest. Texts of any length are
    taken whole. Repeated rows get equal results, an empty table gives no rows, and no other column is read.
    """
    prepare(docs.sparkSession)

    @F.pandas_udf(RESULT)
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for group in _groups([_WORD.findall(t) if isinstance(t, str) else [] for t in texts]):
            for words, runs in zip(group, find_runs(group)):
                named = [{"start": a, "length": n, "period": q} for a, n, q in runs]
                rows.append((len(words), named, collapsed(words, runs)))
        return pd.DataFrame(rows, columns=["n_words", "runs", "collapsed"])

    return find(text)


def drop_repetition(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` where texts with a run are cut to what ``collapsed`` keeps; texts without one, and nulls, stay as they are, as do all other columns."""
    (found,) = free_names(docs, "_runs")
    marked = docs.withColumn(found, periodic_runs(docs, column(text)))
    changed = F.when(F.size(F.col(found)["runs"]) > 0, F.col(found)["collapsed"]).otherwise(column(text))
    return marked.select(*[(changed.alias(c) if c == text else column(c)) for c in docs.columns])

"""Periodic runs against a search of every period, planted ones included."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from loomstar.llm import periodic
from loomstar.llm.grammar import Grammar
from loomstar.llm.queries import QUERIES


def every_run(words):
    found = {}
    for q in range(1, len(words) // 3 + 1):
        at = 0
        while at < len(words) - q:
            if words[at] != words[at + q]:
                at += 1
                continue
            first = at
            while at < len(words) - q and words[at] == words[at + q]:
                at += 1
            if at + q - first >= max(24, 3 * q):
                found.setdefault((first, at + q - first), q)  # the smallest period comes first
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def repetitive(rng, most=90):
    letters = rng.choice([1, 2, 3, 5, 50])
    words = [str(rng.randrange(letters)) for _ in range(rng.randint(0, most))]
    for _ in range(rng.randint(0, 3)):
        period = [str(rng.randrange(letters)) for _ in range(rng.randint(1, 20))]
        at, size = rng.randint(0, len(words)), rng.randint(10, 120)
        words[at:at] = (period * size)[:size]
    return words


def test_against_every_period():
    rng = random.Random(1)
    for _ in range(300):
        texts = [repetitive(rng) for _ in range(rng.randint(0, 6))]
        assert periodic.find_runs(texts) == [every_run(t) for t in texts]


def test_extensions_against_comparing_symbol_by_symbol():
    rng = random.Random(2)
    for _ in range(60):
        text = repetitive(rng, 60)
        value = np.array([-1, *map(int, text), -2])
        stops = value < 0
        grammar = Grammar(value, stops)
        pairs = [(i, j) for i in range(1, len(value)) for j in range(i + 1, len(value))]
        if not pairs:
            continue
        p, q = map(np.array, zip(*rng.sample(pairs, min(len(pairs), 300))))
        ahead, behind = grammar.extend(p, q), grammar.extend(p, q, back=True)
        for i, j, a, b in zip(p.tolist(), q.tolist(), ahead.tolist(), behind.tolist()):
            x = next(k for k in range(len(value)) if value[i + k] != value[j + k])
            y = next(k for k in range(len(value)) if value[i - 1 - k] != value[j - 1 - k])
            assert (a, b) == (x, y)


def test_a_long_text_is_one_block_after_few_levels():
    assert periodic.find_runs([["a"] * 100_000, ["a", "b", "c"] * 30_000]) == [[(0, 100_000, 1)], [(0, 90_000, 3)]]
    value = np.zeros(100_002, np.int64)
    value[[0, -1]] = 1, 2
    assert len(Grammar(value, value > 0).levels) == 2


def test_edges(spark):
    texts = [None, "", " \t\n", "x", "ab" * 20, "y\x0by " * 30, "long " + "x" * 200_000]
    docs = spark.createDataFrame([(i, t, "r", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, _runs string, runs string, n_words int")
    got = {r.doc_id: r.p for r in docs.select("doc_id", periodic.periodic_runs(docs, docs["text"]).alias("p")).collect()}
    assert [got[i].n_words for i in range(7)] == [0, 0, 0, 1, 1, 60, 2] and [len(got[i].runs) for i in range(7)] == [0, 0, 0, 0, 0, 1, 0]
    assert got[5].collapsed == "y" and got[0].collapsed == "" == got[2].collapsed
    kept = periodic.drop_repetition(docs)
    assert kept.columns == docs.columns and {r.doc_id: r.text for r in kept.collect()} == {**dict(enumerate(texts)), 5: "y"}
    assert periodic.drop_repetition(docs.limit(0)).count() == 0


@pytest.fixture
def folder(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, None if i % 50 == 7 else " ".join(repetitive(rng, 200)) + ("\n" if i % 3 else ""), "x") for i in range(300)] + [(None, "a " * 30, "x"), (20, " ".join("ab" * 40), "x")]
    spark.createDataFrame(rows, "doc_id long, text string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path), rows


def test_query_against_every_period(spark, folder):
    path, rows = folder
    got = sorted(map(tuple, QUERIES["op12_periodic_runs"](spark, path).collect()), key=str)
    wanted = []
    for i, text, _ in rows:
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = every_run(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        gone = {k for a, m, q in runs for k in range(a + q, a + m)}
        told = "".join("%d,%d,%d\n" % r for r in runs)
        rest = " ".join(w for k, w in enumerate(words) if k not in gone)
        wanted.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *(hashlib.sha256(t.encode()).hexdigest() for t in (told, rest))))
    assert got == sorted(wanted, key=str)
    assert any(w[1] > 1 for w in wanted)

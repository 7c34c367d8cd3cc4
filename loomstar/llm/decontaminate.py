"""Benchmark passages in documents: phrases of the benchmark are searched in an FM-index of each shard of documents.

A shard is a group of whole documents of one partition. Its index holds the words of the benchmark alone: a run of them
shorter than the shortest phrase cannot hold a phrase and is left out, and any other word ends a run.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F

from loomstar.llm.fm_index import FMIndex
from loomstar.llm.tables import column, free_names, located, prepare
from loomstar.llm.wordbytes import ALNUM, Batch, batch_words, groups
from loomstar.session import stored

WINDOW = 10
#: Bytes of documents per shard, and benchmark words that are broadcast and searched at once; more take further blocks and passes.
SHARD_BYTES, BLOCK_WORDS = 2 << 20, 1 << 20

RESULT = "n_words long, n_hit long, items array<string>, spans array<array<long>>, cleaned string"


class Phrases:
    """Distinct windows of a block of benchmark items, as numbers of that block's words."""

    def __init__(self, items: list[str], texts: list, window: int):
        batch = batch_words([t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts], ALNUM)
        self.vocabulary, number = np.unique(batch.words.hash, return_inverse=True)
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.vocabulary & np.uint64(len(self.sieve) - 1)] = True
        self.names = np.array(items, object)
        by_length: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for i in range(len(texts)):
            own = number[batch.bounds[i] : batch.bounds[i + 1]] + 1
            size = min(window, len(own))
            if size:
                rows = np.lib.stride_tricks.sliding_window_view(own, size)
                by_length.setdefault(size, []).append((rows, np.full(len(rows), i)))
        self.windows = []  # (distinct windows, first item of each in items, items)
        for size, found in sorted(by_length.items()):
            rows, owner = np.concatenate([r for r, _ in found]), np.concatenate([o for _, o in found])
            distinct, which = np.unique(rows, axis=0, return_inverse=True)
            pairs = np.unique(np.stack([which.ravel(), owner], axis=1), axis=0)
            self.windows.append((distinct, np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1)), pairs[:, 1]))
        self.shortest = min(by_length, default=0)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, 0 if it is not a word of the block."""
        out = np.zeros(len(hashes), np.int64)
        maybe = np.flatnonzero(self.sieve[hashes & np.uint64(len(self.sieve) - 1)])
        if len(maybe) and len(self.vocabulary):
            at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
            out[maybe] = np.where(self.vocabulary[at] == hashes[maybe], at + 1, 0)
        return out


def _expanded(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges first..last-1, and which range each is of."""
    size = last - first
    which = np.repeat(np.arange(len(size)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + first[which], which


def shard_hits(batch: Batch, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hit, document, item): which words lie in an occurrence of a window, and the items found in each document."""
    hit, none = np.zeros(len(batch.words.hash), bool), np.zeros(0, np.int64)
    if not phrases.shortest:
        return hit, none, none
    number, doc = phrases.numbers(batch.words.hash), batch.doc
    starts = np.ones(len(number), bool)
    starts[1:] = (number[1:] == 0) | (number[:-1] == 0) | (doc[1:] != doc[:-1])
    edge = np.append(np.flatnonzero(starts), len(number))
    long = np.flatnonzero((np.diff(edge) >= phrases.shortest) & (number[edge[:-1]] > 0)) if len(number) else none
    if not len(long):
        return hit, none, none
    size = np.diff(edge)[long]
    taken, run = _expanded(edge[long], edge[long] + size)
    slot = np.arange(len(taken)) + run
    values, origin = np.zeros(len(taken) + len(long), np.int64), np.zeros(len(taken) + len(long), np.int64)
    values[slot], origin[slot] = number[taken], taken
    index = FMIndex(values, len(phrases.vocabulary) + 1)
    docs, items, change = [], [], np.zeros(len(number) + 1, np.int64)
    for windows, first_item, item in phrases.windows:
        low, high = index.search(windows)
        which = np.flatnonzero(low < high)
        rows, of = _expanded(low[which], high[which])
        at = origin[index.locate(rows)]
        np.add.at(change, at, 1)
        np.add.at(change, at + windows.shape[1], -1)
        seen = np.unique(np.stack([doc[at], which[of]], axis=1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
        listed, of = _expanded(first_item[seen[:, 1]], first_item[seen[:, 1] + 1])
        docs.append(seen[of, 0])
        items.append(item[listed])
    return np.cumsum(change[:-1]) > 0, np.concatenate(docs), np.concatenate(items)


def _spans(raw: bytes, start: np.ndarray, end: np.ndarray, hit: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges of the runs of hit words of one text, from the first word's start to the last one's end."""
    edge = np.flatnonzero(np.diff(hit.view(np.int8), prepend=0, append=0))
    return [(int(start[a]), int(end[b - 1])) for a, b in zip(edge[::2], edge[1::2])]


def _hit_words(texts: list, phrases: Phrases | None) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, set[str]]]:
    """For each text its bytes, where its words start and end, which are hit by the block, and the items found."""
    for _, raw in groups(texts, SHARD_BYTES):
        batch = batch_words(raw, ALNUM)
        hit, found = np.zeros(len(batch.words.hash), bool), [set() for _ in raw]
        if phrases is not None:
            hit, docs, items = shard_hits(batch, phrases)
            for d, i in zip(docs.tolist(), items.tolist()):
                found[d].add(phrases.names[i])
        for i, text in enumerate(raw):
            a, b, at = batch.bounds[i], batch.bounds[i + 1], int(batch.offsets[i])
            yield text, batch.words.start[a:b] - at, batch.words.end[a:b] - at, hit[a:b], found[i]


def _told(value, text: bytes, start: np.ndarray, end: np.ndarray, hit: np.ndarray, items: Iterable[str]) -> tuple:
    """The result of one document; ``value`` is its text as it came."""
    n = int(hit.sum())
    spans, cleaned = [], value if isinstance(value, str) else None
    if n:
        cut = _spans(text, start, end, hit)
        spans = [[len(text[:x].decode("utf-8", "surrogatepass")), len(text[:y].decode("utf-8", "surrogatepass"))] for x, y in cut]
        edges = [0, *(e for s in cut for e in s), len(text)]
        cleaned = b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2])).decode("utf-8", "surrogatepass")
    return len(start), n, sorted(items), spans, cleaned


_COLUMNS = ["n_words", "n_hit", "items", "spans", "cleaned"]


def phrase_blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block_words: int) -> DataFrame:
    """(block, raw): the phrases of the benchmark in blocks of about ``block_words`` words, each built by a task and stored as one row."""
    items = benchmark.select(F.coalesce(column(item_id).cast("string"), F.lit("")).alias("item"), column(text).alias("text")).where("text IS NOT NULL").distinct()
    words = items.agg(F.sum(F.length("text") / 4 + 1)).first()[0] or 0
    number = max(1, ceil(words / block_words))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": frame["block"].iloc[:1].array, "raw": [pickle.dumps(Phrases(frame["item"].tolist(), frame["text"].tolist(), window))]})

    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(number)))
    return stored(dealt.groupBy("block").applyInPandas(build, "block long, raw binary"), "phrases")


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS, into: str = "hits") -> DataFrame:
    """``docs`` and a struct ``into``: n_words, n_hit, items, spans (code points, end exclusive), cleaned (the rest of the text).

    Words are ASCII letters and digits and all characters beyond ASCII, with A-Z as a-z. A window is ``window`` consecutive
    words of an item; an item of fewer words, but not none, is one window. A word inside any occurrence of a window is hit.
    A null or empty text has no words, a benchmark without words hits nothing, an item with a null text is passed over, one
    with a null id is named ''. Repeated rows and items give the same result each time. Texts of any length are searched whole.

    One block of phrases is broadcast at a time. A benchmark of one block takes one pass; of more, one pass for each block,
    which keeps the words it hits, and one that puts them together.
    """
    spark = docs.sparkSession
    prepare(spark)
    blocks = phrase_blocks(benchmark, item_id, item_text, window, block_words)
    names = sorted(r["block"] for r in blocks.select("block").collect())  # numbers of blocks

    def load(block: int) -> Broadcast:
        return spark.sparkContext.broadcast(pickle.loads(blocks.where(F.col("block") == block).first()["raw"]))

    if len(names) <= 1:
        phrases = load(names[0]) if names else None

        @F.pandas_udf(RESULT)
        def search(texts: pd.Series) -> pd.DataFrame:
            values = texts.tolist()
            found = _hit_words(values, phrases.value if phrases else None)
            return pd.DataFrame([_told(v, *f) for v, f in zip(values, found)], columns=_COLUMNS)

        return docs.withColumn(into, search(column(text)))

    placed, file, at = located(docs)
    parts = None
    for block in names:
        phrases = load(block)
        own = stored(placed.select(column(file).alias("file"), column(at).alias("at"), _hit_ranges(phrases)(column(text)).alias("h")).where("size(h.ranges) > 0").select("file", "at", "h.*"), "hits")
        phrases.destroy()
        parts = own if parts is None else parts.unionByName(own)
    whole = parts.groupBy("file", "at").agg(F.flatten(F.collect_list("ranges")).alias("ranges"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

    @F.pandas_udf(RESULT)
    def finish(texts: pd.Series, ranges: pd.Series, items: pd.Series) -> pd.DataFrame:
        values, rows = texts.tolist(), []
        for k, (raw, start, end, hit, _) in enumerate(_hit_words(values, None)):
            for a, b in ranges.iloc[k] if ranges.iloc[k] is not None else ():
                hit[a:b] = True
            rows.append(_told(values[k], raw, start, end, hit, items.iloc[k] if items.iloc[k] is not None else ()))
        return pd.DataFrame(rows, columns=_COLUMNS)

    found_file, found_at, ranges, items = free_names(placed, "_hit_file", "_hit_at", "_ranges", "_items")
    joined = placed.join(whole.toDF(found_file, found_at, ranges, items), (column(file) == column(found_file)) & (column(at) == column(found_at)), "left")
    return joined.select(*[column(c) for c in docs.columns], finish(column(text), column(ranges), column(items)).alias(into))


def _hit_ranges(phrases: Broadcast):
    @F.pandas_udf("ranges array<array<long>>, items array<string>")
    def search(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for _, _, _, hit, items in _hit_words(texts.tolist(), phrases.value):
            edge = np.flatnonzero(np.diff(hit.view(np.int8), prepend=0, append=0))
            rows.append((edge.reshape(-1, 2).tolist(), sorted(items)))
        return pd.DataFrame(rows, columns=["ranges", "items"])

    return search


def remove_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` without the passages of the benchmark; columns as they were.

    A document of which nothing but white space is left is dropped, if it had a passage; all others stay. ``n_chars`` (if
    there is such a column) is counted anew where the text changed. Null and empty texts stay, repeated rows fare alike, texts
    of any length are searched whole, an empty table gives no rows, and columns may have any names.
    """
    (name,) = free_names(docs, "_found")
    found = benchmark_hits(docs, benchmark, text, item_id, item_text, window, into=name)
    hit, rest = F.col(name)["n_hit"] > 0, F.col(name)["cleaned"]
    kept = found.where(~hit | (F.trim(F.regexp_replace(rest, "\\s+", " ")) != ""))
    changed = {text: F.when(hit, rest).otherwise(column(text))}
    if n_chars and n_chars in docs.columns:
        changed[n_chars] = F.when(hit, F.length(rest)).otherwise(column(n_chars)).cast(docs.schema[n_chars].dataType)
    return kept.select(*[changed[c].alias(c) if c in changed else column(c) for c in docs.columns])

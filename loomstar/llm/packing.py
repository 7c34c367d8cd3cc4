"""Packing of documents into token sequences: concatenate all, cut every ``length`` tokens.

First pass: each partition encodes its documents, stores their ids and counts tokens from its own start. Second pass: a prefix
sum over the partitions' totals turns these counts into offsets in the whole, and each document is cut where a sequence
ends. Only the last sequence is shorter than ``length``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from loomstar.llm.tables import BATCH_ROWS, prepare
from loomstar.llm.wordbytes import PIECE, Rule, Words, groups, rule, words
from loomstar.session import scratch_path

LENGTH = 4096
#: Chunks whose ids a task remembers; it then starts anew.
REMEMBERED = 400_000
#: Chunks encoded in one call.
TOGETHER = 1000

_SPACE, _WORD, _SIGN = 0, 1, 2
_KIND = np.full(256, 3, np.uint8)  # apostrophes and bytes beyond ASCII are never cut from their neighbours
_KIND[:128] = _SIGN
_KIND[[0x20, 0x0A]] = _SPACE
_KIND[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = _WORD
_KIND[0x27] = 3
_CHUNK: Rule = rule(lambda b: b not in (0x20, 0x0A))


def _chunks(buffer: np.ndarray) -> Words:
    """Pieces that a word-level tokenizer encodes by themselves: split at blanks and line ends, and between ASCII letters or digits and ASCII signs."""
    return words(buffer, _CHUNK, split=lambda piece: _cuts(_KIND[piece]))


def _cuts(kind: np.ndarray) -> np.ndarray:
    """Positions in front of which a chunk is cut."""
    after, before = kind[1:], kind[:-1]
    return np.flatnonzero(((after == _WORD) & (before == _SIGN)) | ((after == _SIGN) & (before == _WORD))) + 1


class Encoder:
    """Ids of many texts; each distinct chunk is encoded once.

    Holds for tokenizers that cut at white space, and between letters, digits and signs, before anything else, and fold case:
    then the ids of a text are those of its chunks in turn. A text that names one of the added tokens is encoded as a whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        marks = [t.endswith("</w>") for t, _ in sorted(self.tokenizer.get_vocab().items(), key=lambda x: x[1])]
        self.ends_word = np.array(marks, bool)
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[int, int] = {}
        self.flat, self.first = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)
        self.used = 0

    def _ids(self, plain: list[str], other: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks in turn, how many each has). Chunks of letters are encoded many at once, and cut where a word ends."""
        ids, size = [], []
        for at in range(0, len(plain), TOGETHER):
            part = plain[at : at + TOGETHER]
            found = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.ends_word[found]) + 1
            if len(ends) != len(part):  # not a tokenizer with word ends
                alone = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
                found, ends = np.array(list(chain.from_iterable(alone)), np.uint32), np.cumsum([len(x) for x in alone])
            ids.append(found)
            size.append(np.diff(ends, prepend=0))
        alone = [e.ids for e in self.tokenizer.encode_batch_fast(other, add_special_tokens=False)]
        ids.append(np.array(list(chain.from_iterable(alone)), np.uint32))
        size.append(np.array([len(x) for x in alone], np.int64))
        return np.concatenate(ids), np.concatenate(size)

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> np.ndarray:
        """Encode new chunks; returns their slots."""
        letters = np.fromiter((t.isalpha() for t in texts), bool, len(texts))
        order = np.concatenate([np.flatnonzero(letters), np.flatnonzero(~letters)])
        ids, size = self._ids([texts[i] for i in np.flatnonzero(letters).tolist()], [texts[i] for i in np.flatnonzero(~letters).tolist()])
        at = len(self.slot)
        self.slot.update(zip(hashes[order].tolist(), range(at, at + len(texts))))
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(self.used + 2 * len(ids), np.uint32)])
        if at + len(texts) + 1 > len(self.first):
            self.first = np.concatenate([self.first[: at + 1], np.zeros(at + 2 * len(texts) + 1, np.int64)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.first[at + 1 : at + 1 + len(texts)] = self.used + np.cumsum(size)
        self.used += len(ids)
        slots = np.empty(len(texts), np.int64)
        slots[order] = np.arange(at, at + len(texts))
        return slots

    def encode(self, raw: list[bytes]) -> list[np.ndarray]:
        whole = {i for i, t in enumerate(raw) if any(a.encode() in t for a in self.added)}
        buffer = np.frombuffer(b"\n".join(b"" if i in whole else t for i, t in enumerate(raw)) + b"\n", np.uint8)
        bounds = np.concatenate([[0], np.cumsum([(0 if i in whole else len(t)) + 1 for i, t in enumerate(raw)])])
        chunk = _chunks(buffer)
        distinct, example, which = np.unique(chunk.hash, return_index=True, return_inverse=True)
        if len(self.slot) > REMEMBERED:
            self._forget()
        get = self.slot.get
        slots = np.array([get(h, -1) for h in distinct.tolist()], np.int64)
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            text = buffer.tobytes()
            start, end = chunk.start[example[missing]].tolist(), chunk.end[example[missing]].tolist()
            slots[missing] = self._learn(distinct[missing], [text[a:b].decode("utf-8", "replace") for a, b in zip(start, end)])
        slots = slots[which]
        first, size = self.first[slots], self.first[slots + 1] - self.first[slots]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.arange(ends[-1]) - np.repeat(ends[:-1] - first, size)]
        cut = ends[np.searchsorted(chunk.start, bounds)]
        out = [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]
        for i in whole:
            out[i] = np.array(self.tokenizer.encode(raw[i].decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32)
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for all tasks of a Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(docs: DataFrame, path: str, end_id: int, doc_id: str, text: str) -> DataFrame:
    """id, part, before (tokens of the partition ahead), n, ids (little-endian 32-bit, with ``end_id``)."""

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, part, before = encoder(path), TaskContext.get().partitionId(), 0
        for frame in frames:
            for at in range(0, len(frame), 4 * BATCH_ROWS):
                rows = frame.iloc[at : at + 4 * BATCH_ROWS]
                made = []
                for _, raw in groups(rows["text"].tolist(), 2 * PIECE):
                    made += [np.append(x, np.uint32(end_id)).astype("<u4") for x in coder.encode(raw)]
                n = np.array([len(x) for x in made])
                start = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pd.DataFrame({"id": rows["id"].array, "part": part, "before": start, "n": n, "ids": [x.tobytes() for x in made]})

    read = docs.select(F.col(doc_id).cast("long").cast("string").alias("id"), F.col(text).alias("text"))
    made = read.mapInPandas(encode, "id string, part long, before long, n long, ids binary")
    return made.withColumn("id", F.col("id").cast("long"))


def pack(docs: DataFrame, path: str, end_id: int, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece of a document: id, start, size, ids, doc_tokens, sequence_id, offset.

    ``start`` counts the document's ids before the piece, ``offset`` the sequence's. A null or empty text is the end id alone.
    Rows with one id, or none, are documents of their own. Every sequence but the last has ``length`` ids; an empty table
    gives no rows. ``path`` must be readable by every executor.
    """
    spark = docs.sparkSession
    prepare(spark)
    folder = scratch_path(spark, "encoded")
    made = encoded(docs, path, end_id, doc_id, text)
    made.write.option("compression", "zstd").parquet(folder)
    stored = spark.read.schema(made.schema).parquet(folder)
    totals = stored.groupBy("part").agg(F.sum("n").alias("total"))
    # one row per partition: a prefix sum over them is small
    base = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    placed = stored.join(F.broadcast(base), "part").withColumn("at", F.col("base") + F.col("before"))
    last = F.expr(f"(at + n - 1) div {length}")
    cut = placed.withColumn("sequence_id", F.explode(F.sequence(F.expr(f"at div {length}"), last)))
    start = F.greatest(F.col("sequence_id") * length, "at")
    size = F.least((F.col("sequence_id") + 1) * length, F.col("at") + F.col("n")) - start
    pieces = cut.select("id", (start - F.col("at")).alias("start"), size.alias("size"), "ids", F.col("n").alias("doc_tokens"), "sequence_id", (start - F.col("sequence_id") * length).alias("offset"))
    return pieces.withColumn("ids", F.expr("substring(ids, cast(start * 4 + 1 as int), cast(size * 4 as int))"))

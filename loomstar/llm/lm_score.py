"""Cross-entropy difference: two word bigram models over one vocabulary, one of target documents and one of the whole corpus.

Tokens are words; each sign, and each character of a script written without spaces, is one by itself. No token is left out:
counts of all unigrams and bigrams of all documents are kept, so they grow with the input. Both models have the same smoothing.

Documents are packed into chunks of about ``CHUNK`` characters. A chunk sends each of its n-grams once, with its counts, to the
bucket of the n-gram's hash; the bucket adds up what all chunks sent and answers each. A frequent n-gram is thus one entry for
each chunk, and there are as many buckets as the input needs for each to hold about ``BUCKET`` characters' n-grams. A chunk
writes to the buckets of its own n-grams only, so it never sends more rows than it has distinct ones.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from loomstar.llm.grams import codes, slices
from loomstar.llm.tables import column, prepare
from loomstar.session import stored

#: Weights of bigram, unigram and uniform estimates of words.
WORD_MIXTURE = (0.6, 0.35, 0.05)
#: Characters of documents that are packed together, and of those whose n-grams one bucket holds.
CHUNK, BUCKET = 1 << 22, 1 << 22
#: Chunks for each task that adds up or answers.
CHUNKS_EACH = 4
#: Bits of an n-gram's hash.
BITS = 48
#: Scripts that are written without spaces (first and last code points): each character is a token.
UNSPACED = ((0x0E00, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x31FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
_words: list[np.ndarray] = []


def word_table() -> np.ndarray:
    """bool per code point: whether it goes on a word begun before it."""
    if not _words:
        table = np.fromiter((unicodedata.category(chr(i))[0] in "LMN" for i in range(0x110000)), bool, 0x110000)
        for first, last in UNSPACED:
            table[first : last + 1] = False
        _words.append(table)
    return _words[0]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_START, _END = _mixed(np.array([1 << 40, 2 << 40], np.uint64))
_START_UNIGRAM = _START >> np.uint64(64 - BITS)


def word_tokens(group: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token, place of its text in the group): each text begins with a start and ends with an end, and one without a character has neither."""
    parts = [(k, part.lower()) for k, (_, part) in enumerate(group) if part]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = codes("".join(f"\0{part}\0" for _, part in parts))
    size = np.array([len(part) + 2 for _, part in parts])
    begin = np.cumsum(size) - size
    inside = word_table()[value]
    begins = ~inside
    begins[1:] |= ~inside[:-1]
    gap = value == 32  # the first of several spaces parts words, the others are tokens
    gap[1:] &= value[:-1] != 32
    at = np.flatnonzero(begins)
    place = np.arange(len(value)) - np.repeat(at, np.diff(np.append(at, len(value))))
    hashes = _mixed(np.add.reduceat(_mixed(value.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(21)) + np.uint64(1)), at))
    doc = np.repeat([k for k, _ in parts], size)[at]
    hashes[np.searchsorted(at, begin)] = _START
    hashes[np.searchsorted(at, begin + size - 1)] = _END
    keep = ~gap[at]
    return hashes[keep], doc[keep]


def _grams(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unigram, bigram that ends there) of each token, of ``BITS`` bits; a start ends no bigram that counts."""
    pair = hashes.copy()
    pair[1:] = _mixed(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])
    return hashes >> np.uint64(64 - BITS), pair >> np.uint64(64 - BITS)


def _counted(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, sorted, and how often each occurs."""
    return np.unique(value, return_counts=True)


def _planes(value: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones: high bytes are mostly 0, so this is stored in little space."""
    return np.ascontiguousarray(value.view(np.uint8).reshape(-1, value.itemsize).T).tobytes()


def _numbers(raw: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (id, text) to chunks."""
    ids, texts, held, number = [], [], 0, 0
    codec = pa.Codec("zstd", 6)

    def chunk() -> pd.DataFrame:
        whole = "".join(texts).encode("utf-8", "surrogatepass")
        name = (TaskContext.get().partitionId() << 32) + number
        one, _, doc = _tokens(texts)
        tokens = np.bincount(doc[one != _START_UNIGRAM], minlength=len(texts))
        return pd.DataFrame({"chunk": [name], "ids": [ids], "sizes": [[len(t) for t in texts]], "tokens": [tokens.tolist()], "bytes": [len(whole)], "texts": [codec.compress(whole, asbytes=True)]})

    for frame in frames:
        for id_, text in zip(frame["id"], frame["text"]):
            ids.append(None if pd.isna(id_) else int(id_))
            texts.append(text if isinstance(text, str) else "")
            held += len(texts[-1])
            if held >= CHUNK:
                yield chunk()
                ids, texts, held, number = [], [], 0, number + 1
    if ids:
        yield chunk()


def _texts(row) -> list[str]:
    whole = pa.Codec("zstd").decompress(row.texts, decompressed_size=row.bytes, asbytes=True).decode("utf-8", "surrogatepass") if row.bytes else ""
    ends = np.cumsum(row.sizes).tolist()
    return [whole[a:b] for a, b in zip([0, *ends], ends)]


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unigram, bigram, text number) of every token of a chunk."""
    found = []
    for group in slices(texts):
        hashes, k = word_tokens(group)
        found.append((*_grams(hashes), np.array([i for i, _ in group], np.int64)[k] if len(k) else k))
    return tuple(np.concatenate(x) for x in zip(*found))


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, target_loss, corpus_loss (bits per token), score (their difference; lower: more like the target).

    ``target_ids`` has the ids (first column) of the target's documents; these are scored by a model that has seen them, as the
    whole corpus' model has seen all. The end of a text is a token, so only a null or empty text has none, and losses and score
    of 0. The vocabulary that both models share counts as large as the corpus. Without target documents all target losses are
    those of a model without counts. Repeated rows count each time, and equal texts get equal scores. Texts of any length are
    read whole. An empty table gives no rows, and no other column is read.
    """
    spark = docs.sparkSession
    prepare(spark)
    ids = target_ids.select(column(target_ids.columns[0]).cast("long").alias("target_id")).where("target_id IS NOT NULL").distinct()
    rows = docs.select(column(doc_id).cast("long").alias("id"), column(text).alias("text"))
    chunks = stored(rows.mapInPandas(_packed, "chunk long, ids array<long>, sizes array<int>, tokens array<long>, bytes long, texts binary"), "chunks")
    added = lambda c: F.sum(F.aggregate(c, F.lit(0).cast("long"), lambda a, n: a + n))
    most, all_tokens, count = chunks.select(added("sizes"), added("tokens"), F.count(F.lit(1))).first()
    bits = min(max(4, int((most or 0) // BUCKET).bit_length()), BITS - 8)
    # only ids move to find the target's documents; the places of a chunk's are one row
    places = chunks.select("chunk", F.posexplode(F.arrays_zip("ids", "tokens")).alias("place", "d")).select("chunk", "place", "d.ids", "d.tokens")
    chosen = stored(places.join(ids.hint("merge"), F.col("ids") == F.col("target_id"), "left_semi").groupBy("chunk").agg(F.collect_list("place").alias("wanted"), F.sum("tokens").alias("tokens")), "wanted")
    total = {"n": all_tokens or 0, "t": chosen.agg(F.sum("tokens")).first()[0] or 0}
    wanted = chosen.select("chunk", "wanted")

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                one, two, doc = _tokens(_texts(row))
                target = np.zeros(len(row.sizes), bool)
                if row.wanted is not None:
                    target[np.asarray(row.wanted, int)] = True
                begins = one == _START_UNIGRAM
                for order, value, own in ((0, one, slice(None)), (1, two, ~begins)):
                    value, chosen = value[own], target[doc][own]
                    gram, n = _counted(value)
                    t = np.zeros(len(gram), np.uint32)
                    some, number = _counted(value[chosen])
                    t[np.searchsorted(gram, some)] = number
                    bucket = (gram >> np.uint64(BITS - bits)).astype(np.int64)
                    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(gram) else np.zeros(0, int)
                    rest, n = gram & np.uint64((1 << BITS - bits) - 1), n.astype(np.uint32)
                    parts = list(zip(first.tolist(), np.append(first[1:], len(gram)).tolist()))
                    for at in range(0, len(parts), 64):
                        some_parts, which = parts[at : at + 64], bucket[first[at : at + 64]]
                        yield pd.DataFrame({"bucket": order * (1 << bits) + which, "chunk": row.chunk, "grams": [_planes(rest[a:b]) for a, b in some_parts], "n": [_planes(n[a:b]) for a, b in some_parts], "t": [_planes(t[a:b]) for a, b in some_parts]})

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        grams = [_numbers(x, np.uint64) for x in frame["grams"]]
        size = np.cumsum([0, *map(len, grams)])
        distinct, place = np.unique(np.concatenate(grams), return_inverse=True)
        sums = {k: np.bincount(place, np.concatenate([_numbers(x, np.uint32) for x in frame[k]]), len(distinct)).astype(np.int64) for k in "nt"}
        return pd.DataFrame({"bucket": frame["bucket"], "chunk": frame["chunk"]} | {k: [_planes(sums[k][place[a:b]]) for a, b in zip(size, size[1:])] for k in "nt"})

    def judge(packed: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row, answers = next(packed.itertuples(index=False)), answers.sort_values("bucket")
        one, two, doc = _tokens(_texts(row))
        begins = one == _START_UNIGRAM
        parts, bits_of = [answers[answers["bucket"] < 1 << bits], answers[answers["bucket"] >= 1 << bits]], np.zeros((2, len(row.sizes)))
        places = [np.searchsorted(np.unique(value), value) for value in (one, two[~begins])]
        own = np.flatnonzero(~begins)
        before = places[0][own - 1]
        for k, kind in enumerate("tn"):
            if not len(own):
                break
            uni, bi = (np.concatenate([_numbers(x, np.int64) for x in p[kind]]).astype(float) for p in parts)
            context, vocabulary = uni[before], total["n"] + 1
            a, b, c = WORD_MIXTURE
            share = np.divide(bi[places[1]], context, out=np.full(len(own), 1 / vocabulary), where=context > 0)
            chance = a * share + b * uni[places[0][own]] / max(total[kind], 1) + c / vocabulary
            bits_of[k] = np.bincount(doc[own], -np.log2(chance), len(row.sizes))
        n = np.array(row.tokens)
        target, corpus = bits_of / np.maximum(n, 1)
        return pd.DataFrame({"id": pd.array([None if pd.isna(i) else int(i) for i in row.ids], "Int64"), "n_tokens": n, "target_loss": target, "corpus_loss": corpus, "score": target - corpus})

    # partitions grow with the input, so that a task's share does not
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), count // CHUNKS_EACH)
    asked = chunks.join(wanted, "chunk", "left").mapInPandas(ask, "bucket long, chunk long, grams binary, n binary, t binary").repartition(tasks, "bucket")
    answers = asked.groupBy("bucket").applyInPandas(answer, "bucket long, chunk long, n binary, t binary").repartition(tasks, "chunk")
    return chunks.repartition(tasks, "chunk").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(judge, "id long, n_tokens long, target_loss double, corpus_loss double, score double")

"""Quality by nearest-neighbour voting: cosines of latent-semantic vectors with all labelled ones, which are broadcast."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from loomstar.llm.grams import codes, letter_table, slices, text_grams
from loomstar.llm.tables import BATCH_ROWS, held_out, prepare, sized, taken
from loomstar.llm.wordbytes import SPACED, batch_words, groups
from loomstar.session import stored

SIZES, BUCKETS, LATENT = (1, 3), 4096, 64
#: Labelled rows that are broadcast, at most (x LATENT numbers of 4 bytes), and how many of the nearest vote.
SAMPLE_ROWS, VOTERS = 4000, 15
#: Documents whose cosines with all labelled vectors are held at once.
BLOCK = 256
SHAPES = 5 * 8


def shapes(texts: list) -> np.ndarray:
    """float32[texts, SHAPES]: one-hot levels of upper case, signs, digits, word length and repetition."""
    letters = letter_table()
    count = np.zeros((len(texts), 4))
    for group in slices(texts):
        for i, part in group:
            value = codes(part)
            letter = letters[value]
            ascii_ = value < 128
            count[i] += [len(value), ((value >= 65) & (value <= 90)).sum(), (ascii_ & ~letter & (value > 32) & ~((value >= 48) & (value <= 57))).sum(), ((value >= 48) & (value <= 57)).sum()]
    total, different = np.zeros(len(texts)), np.zeros(len(texts))
    for first, raw in groups(texts):
        batch = batch_words(raw, SPACED)
        for k in range(len(raw)):
            own = batch.words.hash[batch.bounds[k] : batch.bounds[k + 1]]
            total[first + k], different[first + k] = len(own), len(np.unique(own))
    size = np.maximum(count[:, 0], 1)
    levels = [
        np.minimum(8 * count[:, 1] / size, 7), np.minimum(40 * count[:, 2] / size, 7), np.minimum(40 * count[:, 3] / size, 7),
        np.minimum(size / np.maximum(total, 1) / 2, 7), np.minimum(2 * np.log2(np.maximum(total, 1) / np.maximum(different, 1)), 7),
    ]
    out = np.zeros((len(texts), SHAPES), np.float32)
    for k, level in enumerate(levels):
        out[np.arange(len(texts)), 8 * k + level.astype(int)] = 1
    return out


def features(texts: list) -> np.ndarray:
    """float32[texts, BUCKETS + SHAPES]: damped counts, with half of the weight on the shapes."""
    grams = np.log1p(text_grams(texts, SIZES, BUCKETS))
    norm = np.linalg.norm(grams, axis=1, keepdims=True)
    return np.concatenate([grams / np.maximum(norm, 1e-9), 0.45 * shapes(texts)], axis=1)


@dataclass
class Model:
    weight: np.ndarray  # float32[features], inverse document frequency
    basis: np.ndarray  # float32[features, LATENT]
    vectors: np.ndarray  # float32[labelled, LATENT], of length 1
    labels: np.ndarray  # float32[labelled]
    prior: float

    def latent(self, rows: np.ndarray) -> np.ndarray:
        found = (rows * self.weight) @ self.basis
        return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-9)

    def votes(self, vectors: np.ndarray, alone: bool = False) -> np.ndarray:
        """Weighted share of label 1 among the nearest; with ``alone``, ``vectors`` are the labelled ones and do not vote for themselves."""
        out, k = np.empty(len(vectors)), min(VOTERS, len(self.labels) - alone)
        for at in range(0, len(vectors), BLOCK):
            cosine = vectors[at : at + BLOCK] @ self.vectors.T
            if alone:
                cosine[np.arange(len(cosine)), at + np.arange(len(cosine))] = -2
            nearest = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            near = np.take_along_axis(cosine, nearest, axis=1)
            weight = np.exp(12 * (near - near.max(axis=1, keepdims=True)))
            out[at : at + BLOCK] = (weight * self.labels[nearest]).sum(axis=1) / weight.sum(axis=1)
        return out

    def scores(self, texts: list) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), self.prior)
        return np.clip(self.votes(self.latent(features(texts))), 0.0, 1.0)


def fit(rows: np.ndarray, labels: np.ndarray, seed: int = 1) -> Model:
    """Latent vectors by a randomised singular value decomposition of the weighted rows."""
    if len(labels) < 2:
        return Model(np.ones(rows.shape[1], np.float32), np.zeros((rows.shape[1], 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32), float(labels[0]) if len(labels) else 0.5)
    seen = (rows > 0).sum(axis=0)
    weight = np.where(np.arange(rows.shape[1]) < BUCKETS, np.log((1 + len(rows)) / (1 + seen)) + 0.2, 1.0).astype(np.float32)
    weighted, rng = rows * weight, np.random.default_rng(seed)
    probe = weighted @ rng.normal(size=(rows.shape[1], LATENT + 16)).astype(np.float32)
    for _ in range(3):
        probe = np.linalg.qr(probe)[0]
        probe = weighted @ (weighted.T @ probe)
    q = np.linalg.qr(probe)[0]
    basis = np.linalg.svd(q.T @ weighted, full_matrices=False)[2][:LATENT].T
    model = Model(weight, np.ascontiguousarray(basis, np.float32), np.zeros((0, 1)), labels.astype(np.float32), float(labels.mean()))
    model.vectors = model.latent(rows).astype(np.float32)
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str, per_class: int) -> DataFrame:
    """(id, text, label) of about ``per_class`` rows of each label (at most twice that in all) that may be learned from."""
    own = labels.select(F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    counts = {r["label"]: r["count"] for r in own.groupBy("label").count().collect()}
    shares = {k: min(1.0, per_class / n) for k, n in counts.items()}
    picked = stored(own.where(taken(F.col("label"), F.col("id"), shares, 21)).limit(2 * per_class).groupBy("id").agg(F.max("label").alias("label")), "picked")
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).join(sized(picked), "id")


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``sample_rows`` labelled rows that are not held out, as many of either label as there are."""
    sample = labelled_sample(docs, labels, label, doc_id, text, sample_rows // 2).limit(sample_rows)

    @F.pandas_udf("binary")
    def rows(texts: pd.Series) -> pd.Series:
        return pd.Series([x.astype(np.float16).tobytes() for x in features(texts.tolist())])

    prepare(docs.sparkSession)
    found = sample.select("id", "label", rows("text").alias("row")).toPandas().sort_values("id", kind="stable")
    matrix = np.stack([np.frombuffer(x, np.float16) for x in found["row"]]).astype(np.float32) if len(found) else np.zeros((0, BUCKETS + SHAPES), np.float32)
    return fit(matrix, found["label"].to_numpy(float))


def score(docs: DataFrame, model: Model, text: Column) -> Column:
    """Score in 0..1 for each row: the weighted share of label 1 among its nearest labelled vectors.

    A null text is scored as an empty one. Without labelled rows every score is 0.5, with one it is that row's label.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def vote(texts: pd.Series) -> pd.Series:
        parts = [shared.value.scores(texts.iloc[at : at + BATCH_ROWS].tolist()) for at in range(0, len(texts), BATCH_ROWS)]
        return pd.Series(np.concatenate(parts) if parts else [])

    return vote(text)

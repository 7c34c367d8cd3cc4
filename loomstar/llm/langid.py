"""Language identification: the average of hashed subword embeddings, a linear softmax over it, and calibrated rejection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from loomstar.llm.grams import word_grams
from loomstar.llm.tables import BATCH_ROWS, column, fraction_of, free_names, held_out, prepare, taken
from loomstar.session import stored

SIZES, BUCKETS, WIDTH = (1, 2, 3), 4096, 16
#: Labelled rows that are learned from, about; of each language at least ``LEAST_ROWS``, if it has so many.
SAMPLE_ROWS, LEAST_ROWS = 3000, 50
#: Share of the sample kept for calibration, and the share of right rows that either rejection may cost.
CALIBRATION, REJECTED = 0.25, 0.0002
#: Temperatures to choose from; bins of scores, and of usualness (from, to, bins).
TEMPERATURES = tuple(0.25 * 1.25**k for k in range(20))
SCORE_BINS, USUAL_BINS = 10_000, (-200.0, 100.0, 6000)
#: N-grams of a text that count for how far it may be from usual: more do not narrow it, as they depend on each other.
GRAMS = 64
UNDETERMINED = "und"


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # float32[BUCKETS, languages]: embeddings times output layer
    bias: np.ndarray
    temperature: float
    least: float  # a lower score is rejected
    logs: np.ndarray | None = None  # float32[BUCKETS, languages]: log2 of the share of each n-gram in each language
    usual: np.ndarray | None = None  # the mean of these over the n-grams of a language's texts
    least_usual: float = -np.inf  # a text less usual is rejected

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        mean = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1e-9)
        return _softmax((mean @ self.table + self.bias) / self.temperature)

    def usualness(self, counts: np.ndarray, best: np.ndarray) -> np.ndarray:
        """How far the n-grams of each text are as likely as is usual in the language ``best``; for few n-grams, less."""
        n = counts.sum(axis=1)
        likely = (counts @ self.logs)[np.arange(len(counts)), best] / np.maximum(n, 1)
        return (likely - self.usual[best]) * np.sqrt(np.minimum(n, GRAMS))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(mean: np.ndarray, label: np.ndarray, calibrate: np.ndarray, languages: list[str], prior: np.ndarray, epochs: int = 40, seed: int = 1) -> Model:
    """Stochastic gradient descent over rows of n-gram shares; ``calibrate`` marks rows that are not learned from."""
    rng, classes = np.random.default_rng(seed), len(languages)
    embed = rng.normal(0, 0.3, (BUCKETS, WIDTH)).astype(np.float32)
    out, bias = rng.normal(0, 0.3, (WIDTH, classes)).astype(np.float32), np.zeros(classes, np.float32)
    rows = np.flatnonzero(~calibrate) if (~calibrate).any() else np.arange(len(label))
    for epoch in range(epochs):
        rate = 4.0 * (1 - epoch / epochs) + 0.01
        rng.shuffle(rows)
        for at in range(0, len(rows), 32):
            part = rows[at : at + 32]
            hidden = mean[part] @ embed
            error = _softmax(hidden @ out + bias)
            error[np.arange(len(part)), label[part]] -= 1
            error /= len(part)
            back = error @ out.T
            out -= rate * 0.25 * hidden.T @ error
            bias -= rate * 0.05 * error.sum(axis=0)
            embed -= rate * 20 * (mean[part].T @ back)
    share = np.bincount(label[rows], minlength=classes) / max(len(rows), 1)
    bias = bias + np.log(np.maximum(prior, 1e-9)) - np.log(np.maximum(share, 1e-9)).astype(np.float32)
    logs, usual = np.zeros((BUCKETS, classes), np.float32), np.zeros(classes, np.float32)
    for k in range(classes):
        own = mean[rows[label[rows] == k]]
        share = own.mean(axis=0, dtype=float) if len(own) else np.zeros(BUCKETS)
        logs[:, k] = np.log2(0.99 * share + 0.01 / BUCKETS)
        usual[k] = (own @ logs[:, k]).mean() if len(own) else 0.0
    return Model(languages, (embed @ out).astype(np.float32), bias.astype(np.float32), 1.0, 0.0, logs, usual)


def calibrated(rows: DataFrame, model: Model) -> Model:
    """``model`` with the temperature and the least score and usualness that the rows (text, lang) call for; all are counted, in bins."""
    shared, low, high, bins = rows.sparkSession.sparkContext.broadcast(model), *USUAL_BINS

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, loss = shared.value, np.zeros(len(TEMPERATURES))
        place = {k: i for i, k in enumerate(known.languages)}
        score, usual = np.zeros((len(TEMPERATURES), SCORE_BINS), np.int64), np.zeros(bins, np.int64)
        for frame in frames:
            for at in range(0, len(frame), BATCH_ROWS):
                part = frame.iloc[at : at + BATCH_ROWS]
                counts, label = word_grams(part["text"].tolist(), SIZES, BUCKETS), part["lang"].map(place).to_numpy()
                letters = counts.sum(axis=1) > 0
                counts, label = counts[letters], label[letters]
                if not len(label):
                    continue
                for k, temperature in enumerate(TEMPERATURES):
                    found = replace(known, temperature=temperature).probabilities(counts)
                    loss[k] -= np.log(np.maximum(found[np.arange(len(label)), label], 1e-12)).sum()
                    best, right = found.argmax(axis=1), found.argmax(axis=1) == label
                    score[k] += np.bincount(np.minimum((found.max(axis=1)[right] * SCORE_BINS).astype(int), SCORE_BINS - 1), minlength=SCORE_BINS)
                far = (known.usualness(counts[right], best[right]) - low) / (high - low) * bins
                usual += np.bincount(np.clip(far.astype(int), 0, bins - 1), minlength=bins)
        for name, values in (("loss", loss[None]), ("usual", usual[None]), *((f"score{k}", score[k][None]) for k in range(len(TEMPERATURES)))):
            used = np.flatnonzero(values[0])
            yield pd.DataFrame({"name": name, "bin": used, "n": values[0][used].astype(float)})

    made = rows.mapInPandas(count, "name string, bin int, n double").groupBy("name", "bin").agg(F.sum("n").alias("n"))
    found = {k: v.sort_values("bin") for k, v in made.toPandas().groupby("name")}  # at most (temperatures + 1) x bins rows
    if "loss" not in found:
        return model
    loss = np.zeros(len(TEMPERATURES))
    loss[found["loss"]["bin"]] = found["loss"]["n"]
    best, chance = int(loss.argmin()), 1 / len(model.languages)

    def least(name: str) -> tuple[float, float, int]:
        """The bin below which the share REJECTED lies, the middle one, and how many rows may be rejected."""
        if name not in found:
            return 0.0, 0.0, -1
        bin_, total = found[name]["bin"].to_numpy(), found[name]["n"].to_numpy().cumsum()
        rank = int(REJECTED * total[-1])
        return bin_[np.searchsorted(total, rank, "right")], bin_[np.searchsorted(total, total[-1] / 2)], rank

    # one rule at every size: the quantile, less a margin that shrinks with the rows known to lie below it
    out = replace(model, temperature=TEMPERATURES[best])
    bin_, _, rank = least(f"score{best}")
    if rank >= 0:
        out.least = bin_ / SCORE_BINS - 0.75 * max(bin_ / SCORE_BINS - chance, 0.0) / (1 + rank)
        bin_, middle, rank = least("usual")
        out.least_usual = low + (bin_ - (middle - bin_) / 4 / (1 + rank)) * (high - low) / bins
    return out


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on about ``sample_rows`` rows (``LEAST_ROWS`` of each language at least) with a language that are not held out; None if there is none."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where(F.col("lang").isNotNull() & ~held_out(F.col("id")))
    counted = rows.groupBy("lang").count().collect()  # a row per language
    if not counted:
        return None
    names = sorted(r["lang"] for r in counted)
    total = {r["lang"]: r["count"] for r in counted}
    each = max(LEAST_ROWS, sample_rows / len(names))
    shares = {k: min(1.0, each / n) for k, n in total.items()}
    sample = rows.where(taken(F.col("lang"), F.col("id"), shares, 11)).limit(int(2 * each * len(names)))

    @F.pandas_udf("binary")
    def shares_of(texts: pd.Series) -> pd.Series:
        counts = word_grams(texts.tolist(), SIZES, BUCKETS)
        counts /= np.maximum(counts.sum(axis=1, keepdims=True), 1)
        return pd.Series([x.tobytes() for x in counts.astype(np.float16)])

    # stored, then taken row by row, so the driver holds one matrix of at most 2 * max(sample_rows, LEAST_ROWS * languages) rows
    found = stored(sample.select("lang", (fraction_of(F.col("id"), 12) < CALIBRATION).alias("calibrate"), shares_of("text").alias("shares")), "shares")
    n = found.count()
    mean, label, calibrate = np.zeros((n, BUCKETS), np.float32), np.zeros(n, np.int64), np.zeros(n, bool)
    for i, row in enumerate(found.toLocalIterator()):
        mean[i], label[i], calibrate[i] = np.frombuffer(row["shares"], np.float16), names.index(row["lang"]), bool(row["calibrate"])
    prior = np.array([total[k] for k in names], float)
    model = fit(mean, label, calibrate, names, prior / prior.sum())
    fitted = taken(F.col("lang"), F.col("id"), shares, 11) & (fraction_of(F.col("id"), 12) >= CALIBRATION)
    return calibrated(rows.where(F.col("lang").isin(names) & ~F.coalesce(fitted, F.lit(False))).select("text", "lang"), model)


def predict(docs: DataFrame, model: Model | None, text: Column) -> Column:
    """A struct: lang (``und`` for a null text or one without a letter), score in 0..1, accepted (not rejected).

    Rejected are texts without a letter, with a low score, or whose n-grams are rare in the language named.

    Depends on the text alone, so equal texts get equal answers. Without a model (no row has a language) everything is ``und``
    and nothing is rejected.
    """
    prepare(docs.sparkSession)
    if model is None:
        return F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"), F.lit(True).alias("accepted"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, accepted boolean")
    def name(texts: pd.Series) -> pd.DataFrame:
        known, parts = shared.value, []
        for at in range(0, len(texts), BATCH_ROWS):
            counts = word_grams(texts.iloc[at : at + BATCH_ROWS].tolist(), SIZES, BUCKETS)
            found = known.probabilities(counts)
            best, score, letters = found.argmax(axis=1), found.max(axis=1).astype(float), counts.sum(axis=1) > 0
            parts.append(pd.DataFrame({"lang": np.where(letters, np.array(known.languages, object)[best], UNDETERMINED), "score": np.where(letters, score, 0.0), "accepted": letters & (score >= known.least) & (known.usualness(counts, best) >= known.least_usual)}))
        return pd.concat(parts) if parts else pd.DataFrame({"lang": [], "score": [], "accepted": []})

    return name(text)


def keep_known(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` whose language is told with confidence, with ``lang`` filled in where it was null; columns as they were, whatever their names.

    Null, empty and letterless texts go, as ``predict`` rejects them; without any labelled row nothing is rejected. Equal texts
    fare alike, so repeated rows all stay or all go. Texts of any length count whole. An empty table gives no rows.
    """
    (named,) = free_names(docs, "_named")
    told = docs.withColumn(named, predict(docs, learn(docs, doc_id, text, lang), column(text)))
    filled = F.coalesce(column(lang), F.col(named)["lang"]).alias(lang)
    return told.where(F.col(named)["accepted"]).select(*[filled if c == lang else column(c) for c in docs.columns])

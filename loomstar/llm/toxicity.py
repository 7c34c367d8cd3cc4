"""Toxic terms, misspelled ones too: Levenshtein automata run along a trie of the lexicon, and the context tells quotation from abuse.

The lexicon (whole words, and stems that any ending may follow) is learned from labelled documents: words and stems that
stand in toxic documents and hardly in others, as many as it takes to cover the toxic ones.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from loomstar.llm.quality import labelled_sample
from loomstar.llm.tables import held_out, prepare
from loomstar.session import stored

#: Labelled rows of either label that the lexicon is learned from, at most. Terms, candidates and spellings are what these hold.
SAMPLE_PER_LABEL = 2000
#: Sampled toxic documents that a term must add to the cover, and the share of documents with it that must be toxic.
SUPPORT, PRECISION = 4, 0.7
#: Terms of different beginnings that the cover looks for in each toxic document.
DEPTH = 3
#: Edits that a term of so many characters may be off by.
EDITS = ((9, 2), (4, 1))
#: Words on either side of a term that are its context, and what is left of a term's weight when it is quoted or reported on.
CONTEXT, QUOTED, REPORTED = 12, 0.35, 0.6
# Quotation marks, and words that report what others say.
MARKS = "\"“”„«»‹›‘’"
REPORTING = frozenset("said says wrote writes called quoted quote quotes term word slur according sagte schrieb zitat wort nannte dit écrit mot terme cite dijo escribió palabra término cita".split())

_WORD = re.compile(r"[^\W_]+")
#: Single letters parted by signs, and words in which signs stand for letters.
_PARTED = re.compile(r"(?<![^\W_])[^\W_](?:[^\w\s][^\W_]){2,}+(?![^\W_])")
_MASKED = re.compile(r"(?<![^\W_])[^\W_]++(?:[*@$#!][^\W_]++)++")


def disguised(low: str) -> list[tuple[int, int, str]]:
    """(start, end, word) of what signs may hide: parted letters are joined, and a sign inside a word is a letter that fits none."""
    found = [(m.start(), m.end(), re.sub(r"[^\w]", "", m[0])) for m in _PARTED.finditer(low)]
    return found + [(m.start(), m.end(), m[0]) for m in _MASKED.finditer(low)]


def allowed(length: int) -> int:
    return next((edits for least, edits in EDITS if length >= least), 0)


class Automaton:
    """All Levenshtein automata of a lexicon at once, run along its trie.

    A state is a set of (trie node, edits so far); a swap of two neighbouring letters is one edit, and between the two a node
    stands with the letter it waits for. Sets are made when they are first reached and kept, so a word costs one
    look-up per letter, and most words end in the empty set after a few. A stem (``word*``) accepts any ending after what
    is within its edits. Terms that are not ``fuzzy`` (None: all are) must be spelled right.
    """

    def __init__(self, terms: list[str], fuzzy: set[str] | None = None):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[int, str, bool]]] = [[]]  # a word and a stem may end alike
        self.reach = [0]  # most edits that any term below allows
        for term in terms:
            stem = term.endswith("*")
            body = term.rstrip("*")
            edits, node = allowed(len(body)) if fuzzy is None or term in fuzzy else 0, 0
            self.reach[0] = max(self.reach[0], edits)
            for letter in body:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.reach.append(0)
                node = self.children[node][letter]
                self.reach[node] = max(self.reach[node], edits)
            self.ends[node].append((edits, term, stem))
        self.sets: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.stems: list[tuple[int, str] | None] = []
        self.words: list[tuple[int, str] | None] = []
        self.dead = self._state(set())
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        todo, full = list(pairs), set()
        while todo:  # a letter left out costs an edit and moves down the trie
            node, edits = todo.pop()
            if (node, edits) in full or edits > self.reach[node[0] if isinstance(node, tuple) else node]:
                continue
            full.add((node, edits))
            if isinstance(node, tuple):
                continue
            todo += [(child, edits + 1) for child in self.children[node].values()]
        key = frozenset(full)
        if key not in self.sets:
            self.sets[key] = len(self.members)
            self.members.append(key)
            self.steps.append({})
            hits = sorted((edits, term, stem) for node, edits in key if not isinstance(node, tuple) for most, term, stem in self.ends[node] if edits <= most)
            self.words.append(next(((e, t) for e, t, _ in hits), None))
            self.stems.append(next(((e, t) for e, t, stem in hits if stem), None))
        return self.sets[key]

    def _step(self, state: int, letter: str) -> int:
        after = set()
        for node, edits in self.members[state]:
            if isinstance(node, tuple):  # the second letter of a swap, or none
                node, wanted = node
                if wanted == letter:
                    after.add((node, edits))
                continue
            after.add((node, edits + 1))  # a letter too many
            for other, child in self.children[node].items():
                after.add((child, edits + (other != letter)))
                if other != letter and letter in self.children[child]:  # two letters swapped: one edit
                    after.add(((self.children[child][letter], other), edits + 1))
        self.steps[state][letter] = found = self._state(after)
        return found

    def match(self, word: str) -> tuple[int, str] | None:
        """(edits, term) of the nearest term that ``word`` spells, or None."""
        state, best = self.start, None
        for letter in word:
            found = self.steps[state].get(letter)
            state = self._step(state, letter) if found is None else found
            if state == self.dead:
                return best
            if (stem := self.stems[state]) is not None and (best is None or stem < best):
                best = stem
        end = self.words[state]
        return end if end is not None and (best is None or end < best) else best


@dataclass
class Model:
    terms: dict[str, float]  # weight of each term spelled right
    misspelled: dict[str, float]  # weight of an unseen misspelling of each term
    seen: dict[str, float] = field(default_factory=dict)  # weights of spellings met in learning
    prior: float = 0.02  # how surely a text without a hit is toxic, where nothing was learned

    def __post_init__(self):
        # a term with many harmless neighbours does not hide others that are further off
        self.automaton, self.known = Automaton(sorted(self.terms), {t for t, w in self.misspelled.items() if w}), {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("automaton", "known")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def weigh(self, word: str) -> float:
        """How surely ``word`` is a toxic term, 0 if it is none."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) > 300_000:
                self.known.clear()
            hit = self.automaton.match(word)
            found = self.terms[hit[1]] if hit and not hit[0] else self.seen.get(word, self.misspelled.get(hit[1], 0.0) / hit[0] if hit else 0.0)
            self.known[word] = found
        return found

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """(score, (start, end, weight in context) of each hit)."""
        low = text.lower()
        hidden = [(a, b, w) for a, b, w in ((a, b, self.weigh(word)) for a, b, word in disguised(low)) if w]
        if not hidden and not any(map(self.weigh, set(_WORD.findall(low)))):
            return self.prior, []
        words = list(_WORD.finditer(low))
        weights, ends = [self.weigh(m[0]) for m in words], [m.end() for m in words]
        starts = [m.start() for m in words]
        for start, end, weight in hidden:  # counts where its first part stands, unless a part is a term by itself
            first, last = bisect_left(starts, start), bisect_left(starts, end)
            if not any(weights[first:last]):
                weights[first], ends[first] = weight, end
        hits, clear = [], 1.0
        for i in (i for i, w in enumerate(weights) if w > 0):
            a, b = max(0, i - CONTEXT), min(len(words), i + CONTEXT + 1)
            before, after = low[words[a].start() : words[i].start()], low[ends[i] : words[b - 1].end()]
            quoted = any(m in before for m in MARKS) and any(m in after for m in MARKS)
            reported = any(words[k][0] in REPORTING for k in range(a, b))
            # abuse is repeated; other terms close by speak against a mere quotation
            others = sum(1 for k in range(a, b) if k != i and weights[k] > 0.5)
            left = (QUOTED if quoted else 1.0) * (REPORTED if reported else 1.0)
            weight = weights[i] * (left if others < 2 else max(left, 0.8))
            hits.append((words[i].start(), ends[i], weight))
            clear *= 1 - weight
        return max(self.prior, 1 - clear), hits


def _features(text: Column) -> Column:
    """Distinct words and their beginnings of 4 to 8 letters (marked ``*``)."""
    words = F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"))
    whole = F.filter(words, lambda w: F.length(w) > 0)
    stems = F.transform(whole, lambda w: F.when(F.length(w) > 4, F.transform(F.sequence(F.lit(4), F.least(F.lit(8), F.length(w) - 1)), lambda k: F.concat(F.substring(w, F.lit(1), k), F.lit("*")))).otherwise(F.array().cast("array<string>")))
    return F.array_distinct(F.concat(whole, F.flatten(stems)))


def _holds(low: str, terms: set[str]) -> list[str]:
    """Which terms (``stem*`` or word) stand in a lower-cased text."""
    return sorted({t for w in set(_WORD.findall(low)) for t in (w, *(f"{w[:k]}*" for k in range(4, min(9, len(w))))) if t in terms})


def _cover(holds: np.ndarray, terms: list[str], toxic: np.ndarray, clean: np.ndarray) -> list[int]:
    """Greedy choice of terms (rows of bool[terms, toxic documents]) until each document has DEPTH of them or what is left is rare."""
    open_, left, chosen = np.full(holds.shape[1], DEPTH), np.ones(len(terms), bool), []
    worth = toxic / (toxic + clean)
    # of equal terms, whole words go before stems and long ones before short ones
    tie = np.array([(not t.endswith("*")) * 100 + len(t) for t in terms]) * 1e-6
    while left.any():
        gain = (holds[:, open_ > 0].sum(axis=1)) * left
        best = int(np.argmax(gain * worth**4 + tie * left))
        if gain[best] < SUPPORT:
            break
        chosen.append(best)
        open_ = np.maximum(open_ - holds[best], 0)
        body = terms[best].rstrip("*")
        left &= np.array([not (t.rstrip("*").startswith(body) or body.startswith(t.rstrip("*"))) for t in terms])
    return chosen


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", per_label: int = SAMPLE_PER_LABEL) -> Model:
    """Learn terms, their weights and those of misspellings from a bounded sample of labelled rows that are not held out."""
    spark = docs.sparkSession
    prepare(spark)
    sample = stored(labelled_sample(docs, labels, label, doc_id, text, per_label).limit(2 * per_label), "labelled")
    drawn = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    own = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
    all_ = {r["label"]: r["count"] for r in own.groupBy(F.col(label).cast("int").alias("label")).count().collect()}
    if not drawn.get(1):
        return Model({}, {})
    # documents of each label that one of the sample stands for
    stands = {k: all_[k] / n for k, n in drawn.items()}
    counted = sample.select("label", F.explode(_features(F.col("text"))).alias("term")).groupBy("term").agg(
        (F.sum("label") * stands[1]).alias("toxic"), (F.sum(1 - F.col("label")) * stands.get(0, 1.0)).alias("clean"), F.sum("label").alias("support")
    )
    sure = counted.where((F.col("support") >= SUPPORT) & (F.col("toxic") >= PRECISION * (F.col("toxic") + F.col("clean"))))
    found = sure.orderBy(F.desc(F.col("toxic") - F.col("clean")), "term").toPandas()
    if not len(found):
        return Model({}, {})
    terms = found["term"].tolist()
    names = spark.sparkContext.broadcast(set(terms))

    @F.pandas_udf("array<string>")
    def held(texts: pd.Series) -> pd.Series:
        return pd.Series([_holds(t.lower(), names.value) if isinstance(t, str) else [] for t in texts])

    rows = sample.where("label = 1").select(held("text").alias("terms")).toPandas()["terms"]
    place = {t: i for i, t in enumerate(terms)}
    holds = np.zeros((len(terms), len(rows)), bool)
    for j, row in enumerate(rows):
        holds[[place[t] for t in row], j] = True
    toxic, clean = found["toxic"].to_numpy(float), found["clean"].to_numpy(float)
    weights = {terms[i]: float((toxic[i] + 0.2) / (toxic[i] + clean[i] + 1)) for i in _cover(holds, terms, toxic, clean)}
    return _with_prior(sample, _misspellings(sample, Model(weights, dict.fromkeys(weights, 1.0)), stands), stands)


def _with_prior(sample: DataFrame, model: Model, stands: dict[int, float]) -> Model:
    """``model`` with the share of toxic documents among those of the sample that have no hit."""
    bare = sample.select("label", F.size(score(sample, model, sample["text"])["hits"]).alias("hits")).where("hits = 0")
    n = {r["label"]: r["count"] * stands.get(r["label"], 1.0) for r in bare.groupBy("label").count().collect()}
    return replace(model, prior=(n.get(1, 0.0) + 0.5) / (sum(n.values()) + 1.0))


def _misspellings(sample: DataFrame, model: Model, stands: dict[int, float]) -> Model:
    """Weights of misspellings: of those met, by the documents they stand in; of others, by how many of a term's were met in which."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<struct<word: string, term: string>>")
    def off(texts: pd.Series) -> pd.Series:
        match, out = shared.value.automaton.match, []
        for text in texts:
            words = set(_WORD.findall(text.lower())) if isinstance(text, str) else set()
            out.append([(w, hit[1]) for w in sorted(words) if (hit := match(w)) and hit[0]])
        return pd.Series(out)

    found = sample.select("label", F.explode(off("text")).alias("w")).groupBy("w.word", "w.term").agg(
        (F.sum("label") * stands.get(1, 1.0)).alias("toxic"), (F.sum(1 - F.col("label")) * stands.get(0, 1.0)).alias("clean")
    )
    met = found.orderBy(F.desc(F.col("toxic") + F.col("clean")), "word", "term").toPandas()
    seen, telling, idle = {}, Counter(), Counter()
    for word, term, toxic, clean in met.itertuples(index=False):
        surely = toxic > 0.7 * (toxic + clean)
        (telling if surely else idle)[term] += 1
        seen[word] = float(toxic / (toxic + clean + 1)) if surely else 0.0
    misspelled = {t: 0.9 * w * (telling[t] + 1) / (telling[t] + idle[t] + 2) for t, w in model.terms.items()}
    # a term with many harmless neighbours is not looked for among them
    return Model(model.terms, {t: w if w >= 0.2 else 0.0 for t, w in misspelled.items()}, seen)


def score(docs: DataFrame, model: Model, text: Column) -> Column:
    """A struct: score in 0..1, hits (start, end, weight; code points of the lower-cased text).

    One less the product of what each hit leaves open. A null or empty text, or one without a hit, has the model's prior; a
    model without terms gives every text the prior. Texts of any length are read whole, repeated rows get equal scores, an
    empty table gives no rows, and of terms equally near to a word the first in order counts.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, hits array<struct<start: long, stop: long, weight: double>>")
    def judge(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.score(t if isinstance(t, str) else "") for t in texts]
        return pd.DataFrame({"score": [s for s, _ in found], "hits": [h for _, h in found]})

    return judge(text)

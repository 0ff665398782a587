"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context windows around what they find.

The lexicon is learned: words, and stems that many words share, which stand in toxic labelled documents far more often than in others. It is
bounded, kept as a trie, and goes to every task. A word of a text is run as a Levenshtein automaton along the trie: the state is a pair of bit sets
(places in the word reached with no and with one edit), so only the branches near the word are visited and misspelled terms are found
in one walk. Before that a word must share its first or last half with a term, and digits that stand for letters are read as letters.

Each find is then judged by the words around it. Quotation marks on both sides, and words of reporting before it, speak for quotation; other finds
and words of address nearby speak for abuse. The learned document score is logistic over sums, maxima and densities of exact, misspelled and stem finds.

Features come from the text alone. Null, empty and clean texts get the score of a text without finds. Repeated rows give repeated results;
without labels of both kinds the lexicon is empty and everybody's score is the share of toxic documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .samples import training_sample

MOST_DOCS = 12_000
MOST_TERMS = 2_000
THRESHOLD = 0.5
WINDOW = 5
LEAST_FUZZY = 5
STEM = (4, 6)
STEMS = "*stem"
CACHE = 300_000  # words remembered per task, nothing but a cache

WORD = re.compile(r"[^\W_]+(?:[$@!*][^\W_]+)*|\S", re.UNICODE)
LETTERS = str.maketrans("013457@$!", "oieastasi")
QUOTES = frozenset("\"'“”„«»‘’`")
#: Words that introduce other people's words, and words that address somebody. Plain lists in four languages.
REPORTING = frozenset("said says wrote called quote quoted quoting word term phrase reported dit écrit mot sagte schrieb wort dijo escribió palabra".split())
ADDRESS = frozenset("you your yours u ur such tu toi vous du dich dein sie usted te tú".split())
FEATURES = 9


def _swapped(word: str) -> tuple[str, str]:
    """The halves of a word of even length whose two middle letters change places."""
    half = len(word) // 2
    return word[:half - 1] + word[half], word[half - 1] + word[half + 1:]


@dataclass
class Trie:
    """Nodes are dictionaries by letter; "" holds the weight of a term that ends there, STEMS that of a stem, which any letters may follow."""

    root: dict = field(default_factory=dict)
    starts: set = field(default_factory=set)
    ends: set = field(default_factory=set)
    heads: set = field(default_factory=set)
    middles: set = field(default_factory=set)

    def add(self, term: str, weight: float) -> None:
        node = self.root
        for c in term:
            node = node.setdefault(c, {})
        node[""] = weight
        if len(term) >= LEAST_FUZZY:
            half = len(term) // 2
            self.starts.add(term[:half])
            self.ends.add(term[-half:])

    def add_stem(self, stem: str, weight: float) -> None:
        node = self.root
        for c in stem:
            node = node.setdefault(c, {})
        node[STEMS] = weight
        half = len(stem) // 2
        self.heads.add(stem[:half])
        self.middles.update((len(stem), shift, stem[-half:]) for shift in (-1, 0, 1))

    def near_stem(self, word: str) -> bool:
        """Whether one edit may lead to a beginning that is a stem: it leaves the stem's first half, or its last half at most one letter off."""
        if len(word) >= STEM[1] and STEM[1] % 2 == 0:  # letters swapped across the middle change both halves of the longest stems
            half = STEM[1] // 2
            head, tail = _swapped(word[:STEM[1]])
            if head in self.heads and (STEM[1], 0, tail) in self.middles and len(head) == half:
                return True
        return len(word) >= STEM[0] - 1 and (any(word[:n // 2] in self.heads for n in range(STEM[0], STEM[1] + 1)) or any(
            (n, shift, word[n - n // 2 + shift:n + shift]) in self.middles for n in range(STEM[0], STEM[1] + 1) for shift in (-1, 0, 1)))

    def near(self, word: str) -> bool:
        """Whether one edit (letters swapped with their neighbours are one) may lead to a term: an edit leaves the first or the last half as it is."""
        n = len(word)
        if n >= LEAST_FUZZY and n % 2 == 0:  # but letters swapped across the middle change both
            head, tail = _swapped(word)
            if head in self.starts and tail in self.ends:
                return True
        return n >= LEAST_FUZZY - 1 and any(word[:h] in self.starts or word[-h:] in self.ends for h in range(max(2, (n - 1) // 2), (n + 1) // 2 + 1))

    def best_stem(self, word: str) -> tuple[float, int]:
        """(weight, edits) of the best stem within one edit of a beginning of the word; stems under LEAST_FUZZY letters only without edits."""
        masks: dict[str, int] = {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | 1 << i
        found, stack = (0.0, 2), [(self.root, 1, 0b11, 0, 0)]
        while stack:
            node, exact, edited, swap, depth = stack.pop()
            if STEMS in node:
                edits = 0 if exact else 1
                if (edits == 0 or depth >= LEAST_FUZZY) and (-edits, node[STEMS]) > (-found[1], found[0]):
                    found = (node[STEMS], edits)
            for c, child in node.items():
                if len(c) == 1:
                    hit = masks.get(c, 0)
                    step = (exact & hit) << 1
                    after = (((edited & hit) << 1) | (exact << 1) | exact | (step << 1) | ((swap & hit) << 2)) & ((2 << len(word)) - 1)
                    if step | after:
                        stack.append((child, step, after, exact & (hit >> 1), depth + 1))
        return found

    def best(self, word: str) -> tuple[float, int]:
        """(weight, edits) of the best term within one edit: the word's automaton walked along the trie."""
        masks: dict[str, int] = {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | 1 << i
        accept, found = 1 << len(word), (0.0, 2)
        stack = [(self.root, 1, 0b11, 0, 0)]
        while stack:
            node, exact, edited, swap, depth = stack.pop()
            if "" in node and (exact | edited) & accept:
                edits = 0 if exact & accept else 1
                if (edits == 0 or depth >= LEAST_FUZZY) and (-edits, node[""]) > (-found[1], found[0]):
                    found = (node[""], edits)
            for c, child in node.items():
                if len(c) == 1:
                    hit = masks.get(c, 0)
                    step = (exact & hit) << 1
                    after = ((edited & hit) << 1) | (exact << 1) | exact | (step << 1) | ((swap & hit) << 2)
                    if step | after:
                        stack.append((child, step, after, exact & (hit >> 1), depth + 1))
        return found


@dataclass
class Lexicon:
    words: dict[str, float]
    stems: dict[str, float]

    def __post_init__(self) -> None:
        self.trie = Trie()
        for word, weight in self.words.items():
            self.trie.add(word, weight)
        for stem, weight in self.stems.items():
            self.trie.add_stem(stem, weight)
        self.cache: dict[str, tuple[float, int] | None] = {}

    def look(self, word: str) -> tuple[float, int] | None:
        """(weight, kind) of a word: 0 exact, 1 misspelled, 2 stem; None if it is no term."""
        found = self.cache.get(word, 0)
        if found == 0:
            found = self._look(word)
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = found
        return found

    def _look(self, word: str) -> tuple[float, int] | None:
        if word in self.words:
            return self.words[word], 0
        for n in range(STEM[1], STEM[0] - 1, -1):
            if word[:n] in self.stems and len(word) >= n:
                return self.stems[word[:n]], 2
        plain = word.translate(LETTERS).replace("*", "") if not word.isalpha() else word
        if self.words and self.trie.near(plain):
            weight, edits = self.trie.best(plain)
            if edits < 2:
                return weight, edits  # letters written as digits or signs alone count as exact
        if self.stems and self.trie.near_stem(plain):
            weight, edits = self.trie.best_stem(plain)
            if edits < 2:
                return weight, 2 if edits == 0 else 1
        return None


def features(text: str, lexicon: Lexicon) -> list[float]:
    tokens = WORD.findall(text.lower())
    terms = {w: f for w in set(tokens) if len(w) > 1 and (f := lexicon.look(w))}
    if not terms:
        return [0.0] * FEATURES
    at = [i for i, w in enumerate(tokens) if w in terms]
    sums, top, quoted, abuse = [0.0, 0.0, 0.0], 0.0, 0, 0
    for k, i in enumerate(at):
        weight, kind = terms[tokens[i]]
        before, after = tokens[max(0, i - WINDOW):i], tokens[i + 1:i + 1 + WINDOW]
        quote = bool(QUOTES & set(before[-2:]) and QUOTES & set(after[:2])) or bool(REPORTING & set(before))
        near = (k > 0 and i - at[k - 1] <= WINDOW) or (k + 1 < len(at) and at[k + 1] - i <= WINDOW)
        hostile = near or bool(ADDRESS & set(before + after))
        weight *= (0.4 if quote else 1.0) * (1.2 if hostile else 1.0)
        quoted, abuse = quoted + quote, abuse + hostile
        sums[kind] += weight
        top = max(top, weight * (0.6 if kind == 1 else 1.0))
    return [top, *(np.log1p(s) for s in sums), float(sums[0] > 0), float(sums[2] > 0), min(1.0, 20 * sum(sums) / len(tokens)),
            quoted / len(at), abuse / len(at)]


def _terms(text: str) -> set[str]:
    words = {w for w in WORD.findall(text.lower()) if len(w) > 2}
    return words | {f"{w[:n]}*" for w in words for n in range(STEM[0], STEM[1] + 1) if len(w) >= n}


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic, clean = Counter(), Counter()
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            (toxic if label else clean).update(_terms(text))
        terms = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array([toxic[t] for t in terms], pa.int64()), pa.array([clean[t] for t in terms], pa.int64())],
            names=["term", "toxic", "clean"])


def learn_lexicon(sample: DataFrame, most_terms: int = MOST_TERMS) -> Lexicon:
    """At most most_terms words and stems whose documents are mostly toxic ones."""
    totals = {bool(r["label"]): r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, clean = totals.get(True, 0), totals.get(False, 0)
    if not toxic or not clean:
        return Lexicon({}, {})
    least = max(4, toxic // 100)
    counts = sample.select("text", "label").mapInArrow(_count, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    rows = (counts.filter((F.col("toxic") >= least) & (F.col("toxic") >= 1.5 * F.col("clean"))).withColumn("weight", weight)
            .filter("weight > 1.6").orderBy(F.desc("toxic"), F.desc("weight"), "term").limit(most_terms).collect())
    weights = {r["term"]: min(r["weight"], 5.0) / 5.0 for r in rows}
    seen = {r["term"]: r["toxic"] for r in rows}
    stems = {t[:-1]: w for t, w in weights.items() if t.endswith("*")}
    words = {t: w for t, w in weights.items() if not t.endswith("*")}
    #: a stem is worth having only if it says more than the words and the shorter stems that have it
    for stem in sorted(stems, key=len, reverse=True):
        inside = [seen[w] for w in words if w.startswith(stem)]
        shorter = any(stem[:n] in stems for n in range(STEM[0], len(stem)))
        if shorter or (inside and max(inside) >= 0.8 * seen[stem + "*"]):
            del stems[stem]
    return Lexicon(words, stems)


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    offset: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.offset, -30, 30)))


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    full, w = np.hstack([x, np.ones((len(x), 1))]), np.zeros(x.shape[1] + 1)
    ridge = np.diag([0.3] * x.shape[1] + [1e-6])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        step = np.linalg.solve((full * (p * (1 - p) + 1e-6)[:, None]).T @ full + ridge, full.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most_docs: int = MOST_DOCS, id: str = "doc_id") -> Model:
    """A model from at most most_docs labelled documents; word counts and nine numbers per document come to the driver."""
    sample = training_sample(docs, labels, label, most_docs, id).select("text", "label")
    lexicon = learn_lexicon(sample)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t, lexicon) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, pa.list_(pa.float64()))], names=["label", "x"])

    rows = sample.selectExpr("text", "cast(label as int) as label").mapInArrow(featured, "label int, x array<double>").collect()
    y = np.array([r["label"] for r in rows], float)
    if not lexicon.words and not lexicon.stems or len(set(y)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(lexicon, np.zeros(FEATURES), float(np.log(share / (1 - share))))
    return Model(lexicon, *_fit(np.array([r["x"] for r in rows]), y))


def score_toxicity(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score): the probability that a document is toxic, one row per row of docs."""
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t or "", model.lexicon) for t in batch.column("text").to_pylist()]).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.scores(x), pa.float64())], names=["id", "score"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(scored, f"id {kind}, score double").withColumnRenamed("id", id)

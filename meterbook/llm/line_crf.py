"""Quality by a linear-chain conditional random field over the lines of a document.

Every line with a word is labelled good or bad. A line's emission score is linear in its own features and those of the lines beside it; a 2 x 2
table scores neighbouring labels. Training maximises the likelihood of labelled documents whose lines all carry the document's label, on a sample of
at most MOST_DOCS documents, by gradient steps over forward-backward expectations. A document's quality is the length-weighted mean of
the good-marginals of its lines, put on the scale of the labels by a logistic fit.

Features come from the text alone. Null and empty texts, and texts without a word, get the share of good documents in training.
Without labels of both kinds that share is everybody's score. Repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .samples import training_sample
from .shared import fresh, portions

MOST_DOCS = 4_000
STEPS = 150
THRESHOLD = 0.3
CELLS = 400_000  # of a padded array: bounds the memory of forward-backward

SYMBOLS, UPPER, DIGITS = b"#*$%&|<>", bytes(range(65, 91)), bytes(range(48, 58))
LOWER = bytes(range(97, 123)) + bytes(range(128, 256))
FEATURES = 12


def line_features(text: bytes) -> tuple[list[tuple[float, ...]], list[int]]:
    """Features and lengths of the lines that have a word."""
    out, sizes = [], []
    seen: set[bytes] = set()
    for line in text.split(b"\n"):
        words = line.split()
        if not words:
            continue
        n, size = len(words), len(line)
        symbols = size - len(line.translate(None, SYMBOLS))
        upper = size - len(line.translate(None, UPPER))
        lower = size - len(line.translate(None, LOWER))
        digits = size - len(line.translate(None, DIGITS))
        distinct = len(set(words)) / n
        repeats = sum(map(bytes.__eq__, words, words[1:])) / n
        tail = line.rstrip()[-1:]
        out.append((
            min(symbols / n, 3.0), min(line.count(b"!") / n, 3.0), upper / max(1, upper + lower), digits / size, repeats,
            (1 - distinct) * min(1.0, n / 20), min(size / n, 30) / 10, min(n, 200) ** 0.5 / 10, float(n < 4),
            float(line in seen), float(tail in b".!?"), min(line.count(b"|") / n, 2.0)))
        sizes.append(size)
        seen.add(line)
    return out, sizes


def beside(x: np.ndarray) -> np.ndarray:
    """Each line's features with those of the line before and after it, and a constant."""
    none = np.zeros((1, x.shape[1]))
    return np.hstack([x, np.vstack([none, x[:-1]]), np.vstack([x[1:], none]), np.ones((len(x), 1))])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    chain: np.ndarray
    slope: float
    offset: float
    prior: float

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return beside((x - self.mean) / self.scale) @ self.weights

    def score(self, quality: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * quality + self.offset, -30, 30)))


def _lse(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def marginals(emission: np.ndarray, mask: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over padded chains: P(good) per line, expected label pairs (2 x 2, summed), log of the partition sum per chain.

    emission[d, t] is the score of good against bad; chain[a, b] that of label b after a.
    """
    docs, steps = emission.shape
    own = np.stack([np.zeros_like(emission), emission], axis=2)
    forward, backward = np.empty((docs, steps, 2)), np.zeros((docs, steps, 2))
    forward[:, 0] = own[:, 0]
    for t in range(1, steps):
        moved = _lse(forward[:, t - 1][:, :, None] + chain[None], 1) + own[:, t]
        forward[:, t] = np.where(mask[:, t, None], moved, forward[:, t - 1])
    for t in range(steps - 2, -1, -1):
        moved = _lse(chain[None] + (own[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(mask[:, t + 1, None], moved, backward[:, t + 1])
    total = _lse(forward[:, -1], 1)
    good = np.exp(np.clip(forward[:, :, 1] + backward[:, :, 1] - total[:, None], -50, 0)) * mask
    pairs = np.zeros((2, 2))
    if steps > 1:
        joint = forward[:, :-1, :, None] + chain[None, None] + (own[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        pairs = (np.exp(np.clip(joint, -50, 0)) * mask[:, 1:, None, None]).sum(axis=(0, 1))
    return good, pairs, total


def padded(sizes: list[int]) -> Iterator[list[int]]:
    """Numbers of documents of like length, together at most CELLS cells when padded."""
    order, group = sorted(range(len(sizes)), key=sizes.__getitem__), []
    for i in order:
        if group and sizes[i] * (len(group) + 1) > CELLS:
            yield group
            group = []
        group.append(i)
    if group:
        yield group


def doc_quality(model: Model, features: list[list], sizes: list[list[int]]) -> list[float | None]:
    """Length-weighted good-marginals per document; None where there is no line."""
    out: list[float | None] = [None] * len(features)
    full = [i for i, f in enumerate(features) if f]
    for group in padded([len(features[i]) for i in full]):
        rows = [full[g] for g in group]
        most = max(len(features[i]) for i in rows)
        emission, mask, weight = np.zeros((len(rows), most)), np.zeros((len(rows), most), bool), np.zeros((len(rows), most))
        for k, i in enumerate(rows):
            n = len(features[i])
            emission[k, :n], mask[k, :n], weight[k, :n] = model.emissions(np.array(features[i])), True, sizes[i]
        good, _, _ = marginals(emission, mask, model.chain)
        for k, value in zip(rows, (good * weight).sum(1) / weight.sum(1), strict=True):
            out[k] = float(value)
    return out


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-6
        g = np.array([((y - p) * x).sum() - 0.01 * a, (y - p).sum()])
        h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum()]])
        step = np.clip(np.linalg.solve(h, g), -5, 5)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def fit(features: list[list], sizes: list[list[int]], labels: list[int]) -> Model:
    labels = np.array(labels, float)
    prior = float((labels.sum() + 1) / (len(labels) + 2))
    keep = [i for i, f in enumerate(features) if f]
    flat = Model(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(3 * FEATURES + 1), np.zeros((2, 2)), 0.0, float(np.log(prior / (1 - prior))), prior)
    if len({labels[i] for i in keep}) < 2:
        return flat
    every = np.concatenate([np.array(features[i]) for i in keep])
    mean, scale = every.mean(0), every.std(0) + 0.05
    batches = []
    for group in padded([len(features[i]) for i in keep]):
        rows = [keep[g] for g in group]
        most = max(len(features[i]) for i in rows)
        x, mask = np.zeros((len(rows), most, 3 * FEATURES + 1)), np.zeros((len(rows), most), bool)
        for k, i in enumerate(rows):
            x[k, :len(features[i])] = beside((np.array(features[i]) - mean) / scale)
            mask[k, :len(features[i])] = True
        batches.append((x, mask, labels[rows]))
    weights, chain, lines = np.zeros(3 * FEATURES + 1), np.zeros((2, 2)), len(every)
    m1, m2 = np.zeros(weights.size + 4), np.zeros(weights.size + 4)
    for step in range(1, STEPS + 1):
        slope, turn = 1e-3 * lines / 100 * weights, 1e-3 * lines / 100 * chain
        for x, mask, y in batches:
            good, pairs, _ = marginals(x @ weights, mask, chain)
            slope = slope + np.einsum("dt,dtf->f", good - y[:, None] * mask, x)
            links = np.maximum(mask.sum(1) - 1, 0)
            turn = turn + pairs - np.array([[(links * (1 - y)).sum(), 0], [0, (links * y).sum()]])
        g = np.concatenate([slope, turn.ravel()]) / lines
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        move = 0.1 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
        weights, chain = weights - move[:-4], chain - move[-4:].reshape(2, 2)
        chain = np.clip(chain, -2.0, 2.0)  # labels of whole documents say little about single turns
    model = Model(mean, scale, weights, chain, 1.0, 0.0, prior)
    quality = np.array([q for q in doc_quality(model, [features[i] for i in keep], [sizes[i] for i in keep])])
    model.slope, model.offset = _fit_logistic(quality, labels[keep])
    return model


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches):
        done = [line_features(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()]
        flat = [np.array(f, np.float32).tobytes() for f, _ in done]
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(flat, pa.binary()), pa.array([s for _, s in done], pa.list_(pa.int32()))], names=["label", "features", "sizes"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most_docs: int = MOST_DOCS, id: str = "doc_id") -> Model:
    """A model from at most most_docs labelled documents: their line features, not their texts, come to the driver."""
    sample = training_sample(docs, labels, label, most_docs, id).select("text", "label")
    rows = sample.selectExpr("text", "cast(label as int) as label").mapInArrow(_featured, "label int, features binary, sizes array<int>").collect()
    features = [np.frombuffer(r["features"], np.float32).reshape(-1, FEATURES).astype(float).tolist() for r in rows]
    return fit(features, [list(r["sizes"]) for r in rows], [r["label"] for r in rows])


def score_quality(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with `score`, the probability of good quality; every other column stays, the text too if it was selected."""
    names = docs.columns

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            done = [line_features(t or b"") for t in batch.column(text).cast(pa.binary()).to_pylist()]
            quality = doc_quality(model, [f for f, _ in done], [s for _, s in done])
            score = [model.prior if q is None else float(model.score(np.array(q))) for q in quality]
            kept = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != text]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(score, pa.float64())], names=[*(n for n in names if n != text), "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text)
    return docs.mapInArrow(scored, f"{schema}, score double")


def judge(docs: DataFrame, labels: DataFrame, id: str = "doc_id") -> DataFrame:
    """(id, score) of all docs by a model trained on the labels."""
    return score_quality(docs.select(id, "text"), train(docs, labels, id=id))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id: str = "doc_id") -> DataFrame:
    """The rows of docs whose score reaches the threshold, with all their columns whatever their names; rows with a null id are scored like others."""
    model, own = train(docs, labels, id=id), fresh(docs, "_crf_")
    hidden = {c: f"{own}own_{c}" for c in docs.columns if c.lower() == "score"}
    key = f"{own}text"
    scored = score_quality(docs.withColumn(key, docs["text"]).withColumnsRenamed(hidden), model, key)
    kept = scored.filter(scored["score"] >= threshold).drop("score")
    return kept.withColumnsRenamed({new: old for old, new in hidden.items()}).select(*docs.columns)

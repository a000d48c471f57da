"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are its own and its two neighbours'; the chain
weighs changes between good and bad lines. A document's quality is the mean of its lines'
forward-backward marginals, weighted by length, put through a logistic curve.

The field is fitted on at most ``FIT_ROWS`` labelled documents, each line taking its
document's label, by full-batch gradient steps on the exact likelihood; chains of the fit are
cut at ``CHAIN`` lines. Scoring is one scan with whole texts and chains of any length; each
step of the chain is taken for all documents of a batch at once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_settled, write_settled
from .toxicity import fold, labelled

FIT_ROWS = 6_000
FOLDS, HELD = 4, 2
CHAIN = 200
STEPS = 150
RIDGE = 1e-3

_SYMBOL = re.compile(r"[|%&#*$@<>{}\[\]\\^~=_+]")
_PUNCT = re.compile(r"[^\w\s]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_DIGIT = re.compile(r"\d")
N_OWN = 14


def line_features(line: str, times: int, lines: int) -> list[float]:
    words = line.split()
    n, size = len(words), max(1, len(line))
    pairs = list(zip(words, words[1:]))
    most = Counter(words).most_common(1)[0][1] if n else 0
    return [
        np.log1p(len(line)), np.log1p(n), len(line) / max(1, n), len(_UPPER.findall(line)) / size,
        len(_PUNCT.findall(line)) / size, len(_DIGIT.findall(line)) / size, len(_SYMBOL.findall(line)) / size,
        line.count("!!") / max(1, n), len(set(words)) / max(1, n), most / max(1, n),
        len(set(pairs)) / max(1, len(pairs)), float(n == 0), float(times > 1), times / lines,
    ]


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Own features of each line, and the lines' weights."""
    lines = text.split("\n")
    times = Counter(lines)
    seen: dict[str, list[float]] = {}
    for line in times:
        seen[line] = line_features(line, times[line], len(lines))
    return np.array([seen[line] for line in lines]), np.array([len(line) + 1.0 for line in lines])


def joined(own: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Own, previous and next line's features, whether there is one, and a constant."""
    first = np.zeros(len(own), bool)
    first[starts[:-1]] = True
    last = np.roll(first, -1)
    before = np.where(first[:, None], 0.0, np.roll(own, 1, axis=0))
    after = np.where(last[:, None], 0.0, np.roll(own, -1, axis=0))
    return np.hstack([own, before, after, first[:, None], last[:, None], np.ones((len(own), 1))])


def marginals(unary: np.ndarray, change: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """P(good) of each line, expected transitions summed over chains, and the log partition sum.

    ``unary``: score of good against bad. ``change[a, b]``: score of b after a.
    """
    size = np.diff(starts)
    order = np.argsort(-size, kind="stable")
    begin, size = starts[:-1][order], size[order]
    longest = int(size.max(initial=0))
    active = [int(np.searchsorted(-size, -t, "left")) for t in range(longest)]  # chains longer than t
    node = np.exp(np.stack([np.zeros_like(unary), unary], axis=1) - np.maximum(unary, 0)[:, None])
    step = np.exp(change)
    alpha, scale = np.zeros_like(node), np.ones(len(unary))
    for t in range(longest):
        at = begin[: active[t]] + t
        a = node[at] if t == 0 else (alpha[at - 1] @ step) * node[at]
        scale[at] = a.sum(axis=1)
        alpha[at] = a / scale[at][:, None]
    beta = np.ones_like(node)
    expected = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        at = begin[: active[t + 1]] + t
        b = beta[at + 1] * node[at + 1] / scale[at + 1][:, None]
        expected += (alpha[at].T @ b) * step
        beta[at] = b @ step.T
    good = alpha[:, 1] * beta[:, 1]
    total = alpha[:, 0] * beta[:, 0] + good
    return good / total, expected, float(np.log(scale).sum() + np.maximum(unary, 0).sum())


class Field:
    """Weights of the chain, and the curve from a document's mean marginal to its score."""

    def __init__(self, mean, spread, weights, change, curve):
        self.mean, self.spread, self.weights, self.change, self.curve = mean, spread, weights, change, curve

    def documents(self, texts: list[str]) -> np.ndarray:
        found = [document_features(t) for t in texts]
        starts = np.concatenate(([0], np.cumsum([len(w) for _, w in found])))
        own = (np.concatenate([x for x, _ in found]) - self.mean) / self.spread
        weight = np.concatenate([w for _, w in found])
        good, _, _ = marginals(joined(own, starts) @ self.weights, self.change, starts)
        share = np.add.reduceat(good * weight, starts[:-1]) / np.add.reduceat(weight, starts[:-1])
        # Rounded, as sums depend in their last digits on what else is in a batch.
        return np.round(1 / (1 + np.exp(-(self.curve[0] + self.curve[1] * share))), 9)


def fit(texts: list[str], labels: np.ndarray, steps: int = STEPS) -> Field:
    found = [document_features(t)[0] for t in texts]
    own = np.concatenate(found)
    mean, spread = own.mean(axis=0), own.std(axis=0) + 1e-6
    own = (own - mean) / spread
    size = np.array([len(x) for x in found])
    starts = np.concatenate(([0], np.cumsum(size)))
    x = joined(own, starts)
    y = np.repeat(labels, size).astype(float)
    cut = np.unique(np.concatenate([np.arange(a, b, CHAIN) for a, b in zip(starts, starts[1:])] + [[len(y)]])).astype(int)
    inner = np.ones(len(y), bool)
    inner[cut[:-1]] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[at - 1].astype(int), y[at].astype(int)), 1)
    each = 1 / np.repeat(size, size)  # a document counts once, however many lines it has
    weights, change = np.zeros(x.shape[1]), np.zeros((2, 2))
    moment, square = [np.zeros(x.shape[1]), np.zeros((2, 2))], [np.zeros(x.shape[1]), np.zeros((2, 2))]
    n = len(texts)
    for step in range(1, steps + 1):
        good, expected, _ = marginals(x @ weights, change, cut)
        slopes = [x.T @ ((good - y) * each) / n + RIDGE * weights, (expected - seen) / len(y) + RIDGE * change]
        for k, (value, slope) in enumerate(zip((weights, change), slopes)):
            moment[k] = 0.9 * moment[k] + 0.1 * slope
            square[k] = 0.99 * square[k] + 0.01 * slope**2
            value -= 0.1 * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    field = Field(mean, spread, weights, change, (0.0, 0.0))
    share = np.concatenate([_shares(field, texts[i : i + 500]) for i in range(0, n, 500)])
    field.curve = _curve(share, labels)
    return field


def _shares(field: Field, texts: list[str]) -> np.ndarray:
    plain = Field(field.mean, field.spread, field.weights, field.change, (0.0, 1.0))
    p = plain.documents(texts)
    return np.log(p / (1 - p))


def _curve(share: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the mean marginal, by Newton steps with a little ridge."""
    x = np.stack([np.ones_like(share), share], axis=1)
    w = np.zeros(2)
    for _ in range(25):
        p = 1 / (1 + np.exp(-x @ w))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2) * 0.1
        w = w - np.linalg.solve(hessian, x.T @ (p - labels) + 0.1 * w)
    return float(w[0]), float(max(w[1], 1e-6))


def scores(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for each row of ``docs``.

    Needs ``doc_id`` and ``text`` there and ``doc_id`` and ``quality`` in ``labels``; labels of
    fold ``HELD`` are never used. A null or empty text is one empty line. Without labels of both
    kinds every score is the share of good ones (0.5 without labels). Repeated rows are scored
    each. An empty table gives an empty result.
    """
    sample = write_settled(labelled(docs, labels, "quality", FOLDS, HELD, rows), "labelled")
    known = [(r["text"] or "", r["label"]) for r in sample.select("text", "label").toLocalIterator()]  # at most ``rows``
    drop_settled(sample)
    y = np.array([label for _, label in known], float)
    field = fit([t for t, _ in known], y) if len(set(y)) == 2 else None
    base = float(y.mean()) if len(y) else 0.5
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = [t or "" for t in part.column("text").to_pylist()]
                found = field.documents(texts) if field else np.full(len(texts), base)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    found = docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")
    return found.select(
        "doc_id",
        fold(F.col("doc_id"), FOLDS).eqNullSafe(F.lit(HELD)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )

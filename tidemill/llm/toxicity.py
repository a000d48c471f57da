"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon is learned from one half of the labelled rows, the trees and the calibration from the
other half, so that chance terms of the first half do not look informative. Features of a
text: lexicon densities (words, and word beginnings for languages that compound), how near
hits stand to second-person words, shares of capitals, punctuation and exclamation marks, and
rates of obfuscated spelling. One scan of the texts finds the features in Python (a helper of
a few lines for each text); trees and calibration are Spark's own models.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import drop_settled, write_settled
from . import textbytes

FIT_ROWS = 20_000  # labelled rows the model is fitted on, at most
LEXICON = 3_000  # terms
FOLDS, HELD = 5, 0

_WORD = re.compile(r"[^\W_]+")
_MASKED = re.compile(r"\w[@$*!]\w")
_LEET = str.maketrans("013457", "oieast")
_SECOND = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos ti tus usted ustedes vosotros".split()
)
_PREFIXES = (5, 6, 7)
NAMES = (
    "length", "word_sum", "word_max", "prefix_sum", "prefix_max", "strong", "density", "second_person",
    "capitals", "punctuation", "exclamation", "masked", "mixed", "masked_hits",
)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; rows without an id are in fold 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(1))


def labelled(docs: DataFrame, labels: DataFrame, column: str, folds: int, held: int, rows: int) -> DataFrame:
    """Texts with their label and fold, not the held-out fold, at most ``rows`` by a hash of the id."""
    known = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col(column).cast("int").alias("label"))
    known = known.dropDuplicates(["doc_id"]).withColumn("fold", fold(F.col("doc_id"), folds)).where(F.col("fold") != held)
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # bounds what is broadcast
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")


def _terms(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return words | {w[:k] + "~" for w in words for k in _PREFIXES if len(w) > k}


def lexicon(rows: DataFrame, size: int) -> dict[str, tuple[float, float]]:
    """Terms that mark the label: log-odds and G statistic, the ``size`` most significant."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                found = list(_terms(text or ""))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.string()), pa.array([label] * len(found), pa.int64())], names=["term", "label"]
                )

    totals = rows.agg(F.sum("label"), F.count("*")).first()
    ones, n = int(totals[0] or 0), int(totals[1])
    if not 0 < ones < n:
        return {}
    p = ones / n
    counts = rows.select("text", F.col("label").cast("long").alias("label")).mapInArrow(explode, "term string, label long")
    counts = counts.groupBy("term").agg(F.sum("label").alias("c1"), F.count("*").alias("c"))
    c1, c = F.col("c1"), F.col("c")
    c0 = c - c1
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(F.lit(0.0))
    g = 2 * (
        part(c1, c * p) + part(c0, c * (1 - p)) + part(ones - c1, (n - c) * p) + part(n - ones - c0, (n - c) * (1 - p))
    )
    weight = F.log((c1 + 4 * p) / (c0 + 4 * (1 - p))) - float(np.log(p / (1 - p)))
    top = counts.where((c1 >= 3) & (c1 > c * p * 2) & (c < n)).select("term", weight.alias("w"), g.alias("g"))
    top = top.where("g > 9").orderBy(F.desc("g"), "term").limit(size)
    return {r["term"]: (float(r["w"]), float(r["g"])) for r in top.collect()}


def _hit(word: str, lex: dict) -> tuple[float, float, bool]:
    """Weight, significance and whether the word itself (not its beginning) is in the lexicon."""
    own = lex.get(word)
    if own:
        return own[0], own[1], True
    for k in reversed(_PREFIXES):
        if len(word) > k and (own := lex.get(word[:k] + "~")):
            return own[0], own[1], False
    return 0.0, 0.0, False


def text_features(text: str, lex: dict[str, tuple[float, float]]) -> list[float]:
    """The features that need words; those of characters are counted for whole batches."""
    low = text.lower()
    words = _WORD.findall(low)
    n = len(words)
    known, mixed, masked_hits = {}, 0, 0
    for w in set(words):
        hit = _hit(w, lex)
        if hit[0]:
            known[w] = hit
        elif not w.isalpha() and not w.isdigit():
            mixed += 1
            if (plain := _hit(w.translate(_LEET), lex))[0]:
                known[w] = plain
                masked_hits += 1
    word = [h for h in known.values() if h[2]]
    begin = [h for h in known.values() if not h[2]]
    near = hits = 0
    if known:
        second = [i for i, w in enumerate(words) if w in _SECOND]
        at = [i for i, w in enumerate(words) if w in known]
        hits = len(at)
        if second:
            at, second = np.array(at), np.array(second)
            after = np.searchsorted(second, at)
            before, after = second[np.maximum(after - 1, 0)], second[np.minimum(after, len(second) - 1)]
            near = int((np.minimum(np.abs(at - before), np.abs(after - at)) <= 5).sum())
    return [
        float(np.log1p(n)), sum(h[0] for h in word), max((h[0] for h in word), default=0.0),
        sum(h[0] for h in begin), max((h[0] for h in begin), default=0.0),
        float(sum(h[1] > 30 for h in known.values())), 100.0 * hits / max(1, n), near / max(1, hits),
        100.0 * len(_MASKED.findall(low)) / max(1, n), 100.0 * mixed / max(1, n), float(masked_hits),
    ]


_CLASS = np.zeros((3, 256), np.int64)
_CLASS[0, 65:91] = 1
_CLASS[1, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1
_CLASS[2, 33] = 1


def shares(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each text the shares of capitals, punctuation and exclamation marks among its bytes."""
    found = np.zeros((3, len(starts) - 1))
    for i, j in textbytes.slices(starts):
        part = data[starts[i] : starts[j]]
        cut = starts[i : j + 1] - starts[i]
        for k in range(3):
            sums = np.concatenate(([0], np.cumsum(_CLASS[k][part])))
            found[k, i:j] = np.diff(sums[cut])
    return found / np.maximum(1, np.diff(starts))


def with_features(docs: DataFrame, lex: dict[str, tuple[float, float]]) -> DataFrame:
    """``docs`` (``text`` replaced) with ``_x``, the features of its ``text``."""
    kept = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            a = np.array([text_features(t.as_py() or "", lex) for t in texts]).reshape(len(texts), 11)
            x = np.hstack([a[:, :8], shares(*textbytes.buffer(texts)).T, a[:, 8:]])
            features = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], features], names=[*kept, "_x"])

    return docs.mapInArrow(scan, f"{schema}, _x array<double>")


def judge(docs: DataFrame, labels: DataFrame, columns: list[str], rows: int = FIT_ROWS, trees: int = 20, depth: int = 3) -> DataFrame:
    """``_doc``, a struct of the ``columns`` of ``docs``, and ``score`` for each row."""
    sample = write_settled(labelled(docs, labels, "toxic", FOLDS, HELD, rows), "labelled")
    first = sample.where(F.col("fold").isin(1, 2))
    lex = lexicon(first, LEXICON)
    fitted = write_settled(with_features(sample.where(~F.col("fold").isin(1, 2)).select("label", "text"), lex), "features")
    ones, n = fitted.agg(F.sum("label"), F.count("*")).first()
    packed = docs.select(F.struct(*columns).alias("_doc"), "text")
    if lex and 0 < (ones or 0) < n:
        train = fitted.select(F.col("label").cast("double").alias("label"), array_to_vector("_x").alias("features"))
        trees_model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, minInstancesPerNode=3, seed=7).fit(train)
        raw = lambda df: trees_model.transform(df).withColumn("raw", vector_to_array("probability")[1])
        curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(
            raw(train).select("label", "raw")
        )
        found = with_features(packed, lex).withColumn("features", array_to_vector("_x"))
        found = curve.transform(raw(found).select("_doc", "raw")).select("_doc", "score")
    else:
        found = packed.select("_doc", F.lit(float((ones or 0) / n) if n else 0.0).alias("score"))
    drop_settled(sample, fitted)
    return found


def scores(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, trees: int = 20, depth: int = 3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for each row of ``docs``.

    Needs ``doc_id`` and ``text`` there and ``doc_id`` and ``toxic`` in ``labels``; labels of fold
    ``HELD`` are never used. The fit takes at most ``rows`` labelled rows. Null and empty texts
    are scored by their (empty) features. Without labels of both kinds every score is the share
    of toxic ones (0 without labels). Repeated rows are scored each; several labels of one id
    count once. An empty table gives an empty result.
    """
    found = judge(docs, labels, ["doc_id"], rows, trees, depth).select(F.col("_doc.doc_id").alias("doc_id"), "score")
    held = fold(F.col("doc_id"), FOLDS).eqNullSafe(F.lit(HELD))
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose score is 0.5 or more."""
    return judge(docs, labels, docs.columns).where("score < 0.5").select("_doc.*")

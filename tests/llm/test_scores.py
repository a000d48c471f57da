"""Quality and toxicity: held-out accuracy, and what rows without text or labels get."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import quality, toxicity

FOLDER = "/root/testdata/sf0.1"


def _auc(rows):
    ones, zeros = ([r["score"] for r in rows if r["label"] == k] for k in (1, 0))
    return np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])


@pytest.mark.parametrize("module,column,folds,held,least", [(toxicity, "toxic", 5, 0, 0.95), (quality, "quality", 4, 2, 0.98)])
def test_held_out(spark, module, column, folds, held, least):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    some = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    rows = module.scores(some, labels).join(labels.withColumnRenamed(column, "label"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == held) for r in rows)
    unseen = [r for r in rows if r["held_out"]]
    assert _auc(unseen) > least
    clean = [r for r in unseen if r["label"] == (0 if column == "toxic" else 1)]
    assert np.mean([r["predicted"] == r["label"] for r in clean]) > 0.98
    assert np.mean([r["predicted"] == r["label"] for r in unseen]) > 0.95


@pytest.mark.parametrize("module,column", [(toxicity, "toxic"), (quality, "quality")])
def test_odd_rows(spark, odd, nothing, module, column):
    small = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    more = labels.union(spark.createDataFrame([(None, 1, 1), (3, None, None)], labels.schema))
    rows = module.scores(odd, labels).collect()  # none of the labelled texts are there, or too few of one kind
    assert len(rows) == 15 and all(0 <= r["score"] <= 1 for r in rows)
    both = docs.union(odd.select((F.col("doc_id") + 10_000_000).alias("doc_id"), "text"))
    rows = [r for r in module.scores(both, more).collect() if r["doc_id"] is None or r["doc_id"] > 9_000_000]
    assert len(rows) == 15 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (10_000_001, 10_000_002)}) == 1
    assert module.scores(nothing, labels).count() == 0
    assert module.scores(odd, labels.where("false")).count() == 15


def test_marginals_against_enumeration():
    rng = np.random.default_rng(0)
    unary, change = rng.normal(size=7), rng.normal(size=(2, 2))
    starts = np.array([0, 3, 4, 7])
    good, _, log_sum = quality.marginals(unary, change, starts)
    total = 0.0
    for a, b in zip(starts, starts[1:]):
        weight, marked = 0.0, np.zeros(b - a)
        for y in itertools.product((0, 1), repeat=b - a):
            score = np.exp(sum(u for u, v in zip(unary[a:b], y) if v) + sum(change[p, q] for p, q in zip(y, y[1:])))
            weight += score
            marked += score * np.array(y)
        assert np.allclose(good[a:b], marked / weight)
        total += np.log(weight)
    assert np.isclose(total, log_sum)


def test_second_person_counts_in_the_whole_text():
    lex = {"vile": (2.0, 40.0)}
    at = toxicity.NAMES.index("second_person")
    share = lambda text: toxicity.text_features(text, lex)[at]
    assert share("vile " * 2000 + "you are vile " * 6000) == (6000 + 5) / 8000
    assert share("you " * 3000 + "plain " * 9 + "vile you vile") == 1.0
    rng = np.random.default_rng(2)
    for words in (rng.choice(["vile", "you", "a", "b", "c", "d", "e", "f", "g"], 3000, p=[0.1, 0.02, *[0.88 / 7] * 7]) for _ in range(5)):
        hits, second = np.flatnonzero(words == "vile"), np.flatnonzero(words == "you")
        assert share(" ".join(words)) == (np.abs(hits[:, None] - second).min(axis=1) <= 5).mean()

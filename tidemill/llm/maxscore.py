"""Exact ranked search by Block-Max MaxScore over a compressed inverted index.

Shards are runs of documents of bounded size. Each is indexed by the task that reads it, with
documents in the order of their length, so that neighbours weigh alike. A term's postings are
blocks of up to ``BLOCK`` documents: gaps and frequencies in one, two or four bytes, and beside
them, uncompressed, the last document and the greatest impact of each block. An impact is what
one occurrence list adds to a score for each unit of the term's weight; it needs the number of
documents and of terms in the whole corpus, which a first pass counts.

A query takes its terms by falling bounds (weight times greatest impact). Lists are *essential*
while all bounds not yet used could still lift a new document to the k-th score; these are
decompressed and added up. Documents found only in the other lists can't be among the best. For
each of those lists the candidates look up the block they would be in: whose score so far,
that block's maximum and the bounds of the lists after it stay below the k-th score is
rejected, and only blocks that still hold a candidate are decompressed. The k-th score rises
with every list and is carried from shard to shard in the task's heap; comparisons are strict,
so ties are never lost. The heaps of all tasks are merged exactly.

Scores are sums of integers; the order of adding does not matter.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_settled, write_settled
from . import textbytes
from .order import END, ROW, positions

BLOCK = 64
SHARD = 16 << 20  # bytes of text in a shard; a longer text is a shard of its own
TERMS = 500_000  # distinct terms of queries handed to the tasks at a time; a longer query goes alone

# Bytes between terms: ASCII other than letters and digits.
GAP = np.zeros(256, bool)
GAP[:128] = True
GAP[[ord(c) for c in string.ascii_letters + string.digits]] = False

_FIELDS = {
    "sizes": np.int64,  # documents: number of terms
    "terms": np.int64,  # sorted hashes
    "spread": np.int32,  # documents of each term
    "most": np.int32,  # greatest impact of each term
    "blocks": np.int32,  # number of blocks of each term
    "last": np.int32,  # blocks: last document
    "peak": np.int32,  # greatest impact
    "width": np.uint8,  # bytes a number
    "one": np.uint8,  # gaps, then frequencies, of each block of this width
    "two": np.uint16,
    "four": np.uint32,
}
_SCHEMA = "ids array<long>, " + ", ".join(f"{name} binary" for name in _FIELDS)
_KINDS = ((1, "one"), (2, "two"), (4, "four"))


def _terms(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """Slices of the column ``text``: first and last row, bytes, hash of each term and its row in the slice."""
    data, starts = textbytes.buffer(batch.column("text"))
    for i, j in textbytes.slices(starts):
        hashed, text, _ = textbytes.words(data[starts[i] : starts[j]], starts[i : j + 1] - starts[i], GAP)
        yield i, j, int(starts[j] - starts[i]), hashed.view(np.int64), text


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """How many documents hold a term, and how many terms there are, with repeats."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = total = 0
        for batch in batches:
            data, starts = textbytes.buffer(batch.column("text"))
            for i, j in textbytes.slices(starts):
                inside = ~GAP[data[starts[i] : starts[j]]]
                first = inside.copy()
                first[1:] &= ~inside[:-1]
                edges = starts[i:j] - starts[i]
                edges = edges[edges < len(inside)]
                first[edges] = inside[edges]  # a text begins anew
                before = np.concatenate(([0], np.cumsum(first)))
                n = np.diff(before[starts[i : j + 1] - starts[i]])
                some, total = some + int((n > 0).sum()), total + int(n.sum())
        yield pa.RecordBatch.from_arrays([pa.array([some]), pa.array([total])], names=["some", "total"])

    some, total = docs.select("text").mapInArrow(count, "some long, total long").agg(F.sum("some"), F.sum("total")).first()
    return some or 0, total or 0


def _lengths(sizes: np.ndarray, n: int, total: int) -> np.ndarray:
    """m = 25 + 75 * size * n div total, whole numbers of any size."""
    distinct, which = np.unique(sizes, return_inverse=True)
    return np.array([25 + 75 * s * n // max(1, total) for s in distinct.tolist()], np.int64)[which]


def _impact(count: np.ndarray, length: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * count // (1000 * count + 8 * length)


def index(docs: DataFrame, n: int, total: int) -> DataFrame:
    """A row for each shard of ``docs`` (``id`` long, ``text``), given :func:`corpus_size`."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, terms, of, rows, held = [], [], [], 0, 0
        for batch in batches:
            own = batch.column("id")
            for i, j, size, hashed, text in _terms(batch):
                ids.append(own.slice(i, j - i)), terms.append(hashed), of.append(text + rows)
                rows, held = rows + j - i, held + size
                if held >= SHARD:
                    yield _shard(ids, terms, of, n, total)
                    ids, terms, of, rows, held = [], [], [], 0, 0
        if rows:
            yield _shard(ids, terms, of, n, total)

    return docs.mapInArrow(build, _SCHEMA)


def _shard(ids: list, terms: list, of: list, n: int, total: int) -> pa.RecordBatch:
    ids, terms, of = pa.concat_arrays(ids), np.concatenate(terms), np.concatenate(of)
    size = np.bincount(of, minlength=len(ids))
    order = np.argsort(size, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    vocabulary, term = np.unique(terms, return_inverse=True)
    pair, count = np.unique(term * len(ids) + place[of], return_counts=True)
    term, doc = pair // len(ids), pair % len(ids)
    impact = _impact(count, _lengths(size[order], n, total)[doc])
    spread = np.bincount(term, minlength=len(vocabulary))
    starts = np.cumsum(spread) - spread
    blocks = -(-spread // BLOCK)
    begin, many = _ranges(starts, blocks, BLOCK)
    end = np.minimum(begin + BLOCK, np.repeat(starts + spread, many))
    gap = np.diff(doc, prepend=0)
    gap[starts] = doc[starts]
    largest = np.maximum.reduceat(np.maximum(gap, count), begin) if len(begin) else begin
    width = np.where(largest < 1 << 8, 1, np.where(largest < 1 << 16, 2, 4))
    cells = {
        "sizes": size[order], "terms": vocabulary, "spread": spread, "blocks": blocks, "last": doc[end - 1], "width": width,
        "most": np.maximum.reduceat(impact, starts) if len(starts) else starts,
        "peak": np.maximum.reduceat(impact, begin) if len(begin) else begin,
    }
    for bytes_each, name in _KINDS:
        own = np.flatnonzero(width == bytes_each)
        at, _ = _ranges(begin[own], end[own] - begin[own], 1)
        cells[name] = np.concatenate((gap[at], count[at]))
    columns = [pa.array([ids.take(pa.array(order)).to_pylist()], pa.list_(pa.int64()))]
    columns += [pa.array([cells[name].astype(kind).tobytes()], pa.binary()) for name, kind in _FIELDS.items()]
    return pa.RecordBatch.from_arrays(columns, names=["ids", *_FIELDS])


def _ranges(begin: np.ndarray, many: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """begin, begin + step, ... ``many`` times for each range, one range after the other."""
    before = np.cumsum(many) - many
    inner = np.arange(int(many.sum())) - np.repeat(before, many)
    return np.repeat(begin, many) + inner * step, many


class Heap:
    """The best k of what was offered: score above 0, then smaller id, a null id last."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """What a further document must reach: the k-th score, or 1."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def offer(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        scores, ids, known = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.known, known)))
        best = np.lexsort((ids, ~known, -scores))[: self.k]
        self.scores, self.ids, self.known = scores[best], ids[best], known[best]


class Shard:
    """One shard's index, ready to be asked. ``opened`` counts decompressed blocks, ``passed`` those of all terms asked."""

    def __init__(self, row: dict[str, bytes], ids: pa.Array, n: int, total: int):
        for name, kind in _FIELDS.items():
            setattr(self, name, np.frombuffer(row[name], kind))
        self.ids, self.known = np.asarray(ids.fill_null(0)), ~np.asarray(ids.is_null())
        self.lengths = _lengths(self.sizes, n, total)
        self.block_starts = np.concatenate(([0], np.cumsum(self.blocks, dtype=np.int64)))
        count = np.full(len(self.last), BLOCK, np.int64)  # postings of each block
        final = self.block_starts[1:] - 1
        count[final] = self.spread - (self.blocks - 1) * BLOCK
        self.count = count
        self.base = np.concatenate(([0], self.last[:-1])).astype(np.int64)  # document before a block's first gap
        self.base[self.block_starts[:-1]] = 0
        self.offset = np.zeros(len(self.last), np.int64)
        for bytes_each, _ in _KINDS:
            own = np.flatnonzero(self.width == bytes_each)
            self.offset[own] = np.cumsum(count[own]) - count[own]
        self.total = np.zeros(len(self.ids), np.int64)
        self.opened = self.passed = 0

    def postings(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of some blocks of one term."""
        docs, impacts = [], []
        self.opened += len(blocks)
        for bytes_each, name in _KINDS:
            own = blocks[self.width[blocks] == bytes_each]
            if not len(own):
                continue
            stored = getattr(self, name)
            at, many = _ranges(self.offset[own], self.count[own], 1)
            running = np.cumsum(stored[at], dtype=np.int64)
            ends = np.cumsum(many)
            before = np.concatenate(([0], running[ends[:-1] - 1]))
            doc = running + np.repeat(self.base[own] - before, many)
            count = stored[at + len(stored) // 2].astype(np.int64)
            docs.append(doc), impacts.append(_impact(count, self.lengths[doc]))
        return np.concatenate(docs), np.concatenate(impacts)

    def top(self, terms: np.ndarray, weights: np.ndarray, heap: Heap) -> None:
        """Offer the heap whatever may be among the best for the query; weights are above 0."""
        at = np.searchsorted(self.terms, terms)
        here = self.terms[np.minimum(at, len(self.terms) - 1)] == terms if len(self.terms) else np.zeros(len(terms), bool)
        at, weights = at[here], weights[here]
        bounds = weights * self.most[at]
        order = np.argsort(-bounds, kind="stable")
        at, weights = at[order], weights[order]
        left = np.append(np.cumsum(bounds[order][::-1])[::-1], 0)  # what the lists from here on can add at most
        self.passed += int(self.blocks[at].sum())
        score, least, i = self.total, heap.least, 0
        score[:] = 0
        while i < len(at) and left[i] >= least:  # essential
            docs, impacts = self.postings(np.arange(self.block_starts[at[i]], self.block_starts[at[i] + 1]))
            score[docs] += weights[i] * impacts
            least = max(least, _kth(score, heap.k))
            i += 1
        open_ = np.flatnonzero((score > 0) & (score + left[i] >= least))
        for j in range(i, len(at)):
            first, end = self.block_starts[at[j]], self.block_starts[at[j] + 1]
            block = first + np.searchsorted(self.last[first:end], open_)
            inside = block < end
            bound = np.where(inside, weights[j] * self.peak[np.minimum(block, end - 1)].astype(np.int64), 0)
            fits = score[open_] + bound + left[j + 1] >= least
            open_, block = open_[fits], block[fits & inside]
            if not len(open_):
                return
            wanted = np.unique(block)
            if len(wanted):
                docs, impacts = self.postings(wanted)
                score[docs] += weights[j] * impacts
                least = max(least, _kth(score[open_], heap.k))
        open_ = open_[score[open_] >= least]
        if len(open_):
            heap.offer(score[open_], self.ids[open_], self.known[open_])


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def query_terms(queries: DataFrame) -> DataFrame:
    """``query`` (a number of the row), ``id``, and the sorted distinct ``terms`` with their ``times``."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            terms, times = [], []
            for i, j, _, hashed, text in _terms(batch):
                at = np.searchsorted(text, np.arange(j - i + 1))
                for a, b in zip(at, at[1:]):
                    own, n = np.unique(hashed[a:b], return_counts=True)
                    terms.append(own), times.append(n)
            rows = np.arange(number, number + batch.num_rows)
            number += batch.num_rows
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (terms, times)]
            yield pa.RecordBatch.from_arrays([pa.array(rows), batch.column("id"), *lists], names=["query", "id", "terms", "times"])

    return queries.select("id", "text").mapInArrow(split, "query long, id long, terms array<long>, times array<long>")


def _blocked(asked: DataFrame, terms: int) -> DataFrame:
    """``asked`` with ``block``, runs of queries of ``terms`` terms and at most one query more, however they are partitioned."""
    sized = asked.where(F.size("terms") > 0).withColumn("_size", F.size("terms").cast("long"))
    placed = positions(sized, [F.col("query")], "_size")
    return placed.withColumn("block", F.floor((F.col(END) - 1) / F.lit(terms)).cast("long")).drop("_size", ROW, END)


def _frequencies(shards: DataFrame, terms: np.ndarray) -> dict[int, int]:
    """In how many documents each of the terms (sorted) is; at most one row for each comes back."""
    shared = shards.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        found = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                own, spread = (np.frombuffer(batch.column(c)[row].as_py(), _FIELDS[c]) for c in ("terms", "spread"))
                at = np.searchsorted(own, wanted)
                here = own[np.minimum(at, len(own) - 1)] == wanted if len(own) else np.zeros(len(wanted), bool)
                found[here] += spread[at[here]]
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(wanted[some]), pa.array(found[some])], names=["term", "n"])

    counted = shards.select("terms", "spread").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n"))
    return dict(map(tuple, counted.collect()))


def _ask(shards: DataFrame, rows: list, weights: list[np.ndarray], n: int, total: int, k: int) -> DataFrame:
    """Each task's heap for each query: ``query``, ``id``, ``score``."""
    terms = [np.asarray(r["terms"], np.int64) for r in rows]
    shared = shards.sparkSession.sparkContext.broadcast(([r["query"] for r in rows], [t[w > 0] for t, w in zip(terms, weights)], [w[w > 0] for w in weights]))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, terms, weights = shared.value
        heaps = [Heap(k) for _ in names]
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard({c: batch.column(c)[row].as_py() for c in _FIELDS}, batch.column("ids")[row].values, n, total)
                for own, weight, heap in zip(terms, weights, heaps):
                    shard.top(own, weight, heap)
        query = np.repeat(np.asarray(names, np.int64), [len(h.ids) for h in heaps])
        ids, known, scores = (np.concatenate([getattr(h, x) for h in heaps]) for x in ("ids", "known", "scores"))
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(ids, mask=~known), pa.array(scores)], names=["query", "id", "score"])

    return shards.mapInArrow(ask, "query long, id long, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``id`` and ``score`` of the ``k`` best of ``docs`` for each of ``queries``.

    Both have ``id`` (long) and ``text``. Terms are runs of ASCII letters, digits and
    whatever is not ASCII; A-Z is lower-cased. Null and blank texts hold no terms: they are not
    found, do not count, and as queries have no rows. Repeated rows of either table are taken
    each for itself; null ids stay, among equal scores last. Terms are compared by 64-bit hashes.
    Empty tables give an empty result.
    """
    spark = docs.sparkSession
    n, total = corpus_size(docs)
    shards = write_settled(index(docs.select("id", "text"), n, total), "postings")
    asked = write_settled(query_terms(queries), "asked")
    blocked = _blocked(asked, TERMS)
    found = []
    for (block,) in sorted(blocked.select("block").distinct().collect()):
        rows = blocked.where(F.col("block") == block).select("query", "terms", "times").collect()
        wanted = np.unique(np.concatenate([np.asarray(r["terms"], np.int64) for r in rows]))
        frequency = _frequencies(shards, wanted)
        weights = [
            np.asarray(r["times"], np.int64)
            * np.array([int(1000 * np.log((2 * n + 2) / (2 * frequency[t] + 1))) if t in frequency else 0 for t in r["terms"]], np.int64)
            for r in rows
        ]
        found.append(write_settled(_ask(shards, rows, weights, n, total, k), "heaps"))
    drop_settled(shards)
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    merged = found[0]
    for more in found[1:]:
        merged = merged.union(more)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    best = merged.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.join(asked.select("query", F.col("id").alias("query_id")), "query").select("query_id", "rank", "id", "score")


SQL = """
WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+') AS t
  FROM documents),
sizes AS MATERIALIZED (SELECT row, doc_id, len(t) AS n FROM texts WHERE len(t) > 0),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
asked AS MATERIALIZED (
  SELECT item, item_id, term, count(*) AS times FROM (
    SELECT item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+')) AS term
    FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)) GROUP BY ALL),
held AS MATERIALIZED (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(t) AS term FROM texts)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM held, whole GROUP BY term, n_docs),
scored AS (
  SELECT item, item_id, row, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN sizes USING (row), whole
  GROUP BY item, item_id, row, doc_id),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

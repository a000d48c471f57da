"""Compression of vectors to short codes: a codebook for each part of the vector, entries found by a tree.

Components are turned into integers once. Every round one pass assigns each part of every
vector to its codebook's nearest entry, found by a :class:`~.gnat.Gnat` over the entries that
the tasks receive ready built; tasks keep sums and counts of each entry, an aggregation adds
them, and the driver sees only the entries (``entries`` times the width of a vector). No vector
moves between tasks, and a lost task is simply run again.

Defined cases: rows whose vector is null, or holds null or non-finite components, go. The
width is that of the kept row with the smallest id (a null id is last). Rows of another width,
or with a component too large for exact distances in 64 bits, stay with a null code and error
and teach nothing. Widths that ``parts`` does not divide are cut as evenly as possible. Repeated
rows count each. With fewer rows than ``entries`` the codebooks are smaller. An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_settled, write_settled
from .gnat import Gnat

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE = 1024
BATCH = 8_192  # vectors asked at a time
HOT = 1_024  # a label with more than 1/HOT of all rows is hot: there are fewer than HOT of them

Codebooks = list[np.ndarray]  # for each part, an entry a row


def integers(vectors: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vectors`` with ``column`` replaced by ``_v``, its components as floor(scale * x); unusable rows go."""
    rest = [f for f in vectors.schema.fields if f.name != column]
    schema = T.StructType([*rest, T.StructField("_v", T.ArrayType(T.LongType()))])
    names = [f.name for f in rest]

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(column)
            width = np.asarray(lists.value_lengths().fill_null(0), np.int64)
            values = lists.flatten()
            x = np.asarray(values.cast(pa.float64()).fill_null(np.nan), float)
            row = np.repeat(np.arange(len(width)), width)
            good = ~np.asarray(lists.is_null())
            good[row[~np.isfinite(x)]] = False
            x = x[good[row]]
            # What does not fit is put at the end of the range, beyond what is coded.
            whole = np.clip(np.floor(x * scale), -(2.0**62), 2.0**62).astype(np.int64)
            starts = np.concatenate(([0], np.cumsum(width[good]))).astype(np.int32)
            keep = pa.array(good)
            columns = [batch.column(n).filter(keep) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(starts), pa.array(whole))], names=[*names, "_v"])

    return vectors.select(*names, F.col(column).cast("array<double>").alias(column)).mapInArrow(convert, schema)


def _limit(width: int) -> int:
    """Components up to this, so that a sum of squared differences over the width stays below 2^62."""
    return math.isqrt((1 << 62) // (4 * max(1, width)))


def _cuts(width: int, parts: int) -> list[int]:
    return [width * p // parts for p in range(parts + 1)] if parts else [0]


def _codable(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have the width and the range, and their components."""
    own = np.asarray(column.value_lengths(), np.int64)
    flat = np.asarray(column.flatten(), np.int64)
    good = own == width
    row = np.repeat(np.arange(len(own)), own)
    good[row[np.abs(flat) > _limit(width)]] = False
    return good, flat[good[row]].reshape(int(good.sum()), width)


def _assigned(v: np.ndarray, trees: list[Gnat], cuts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's entry in each part, and its squared distances summed over the parts."""
    index = np.zeros((len(v), len(trees)), np.int64)
    error = np.zeros(len(v), np.int64)
    for i in range(0, len(v), BATCH):
        for p, tree in enumerate(trees):
            index[i : i + BATCH, p], own = tree.nearest(v[i : i + BATCH, cuts[p] : cuts[p + 1]])
            error[i : i + BATCH] += own
    return index, error


def _sums(whole: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """``part``, ``entry``, ``n`` and the sum of each component, of all parts assigned to the entry."""
    trees, cuts = [Gnat(b) for b in books], _cuts(width, len(books))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(b.shape, np.int64) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            _, v = _codable(batch.column("_v"), width)
            index, _ = _assigned(v, trees, cuts)
            for p in range(len(books)):
                np.add.at(totals[p], index[:, p], v[:, cuts[p] : cuts[p + 1]])
                counts[p] += np.bincount(index[:, p], minlength=len(counts[p]))
        for p in range(len(books)):
            used = np.flatnonzero(counts[p])
            columns = [np.full(len(used), p), used, counts[p][used]]
            sums = pa.array(list(totals[p][used]), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), sums], names=["part", "entry", "n", "sums"])

    parts = whole.select("_v").mapInArrow(add, "part long, entry long, n long, sums array<long>")
    counted = parts.groupBy("part", "entry").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")) for i in range(-(-width // len(books)))]).alias("sums"),
    )
    return counted


def fit(whole: DataFrame, id_column: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[Codebooks, int]:
    """Codebooks after ``rounds`` rounds over :func:`integers`, and the width; no codebooks for an empty table."""
    order = [F.col(id_column).asc_nulls_last(), F.col("_v")]
    first = whole.orderBy(*order).select(F.size("_v")).first()
    if first is None:
        return [], 0
    width = first[0]
    fits = F.forall("_v", lambda x: F.abs(x) <= _limit(width))
    start = whole.where((F.size("_v") == width) & fits).orderBy(*order).limit(entries).select("_v").collect()
    if not start:
        return [], width
    v, cuts = np.array([r[0] for r in start], np.int64).reshape(len(start), width), _cuts(width, parts)
    books = [v[:, cuts[p] : cuts[p + 1]].copy() for p in range(parts)]
    for _ in range(rounds):
        for part, entry, n, sums in _sums(whole, books, width).collect():  # one row for each entry
            size = cuts[part + 1] - cuts[part]
            books[part][entry] = [int(s) // n for s in sums[:size]]
    return books, width


def encode(whole: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """``whole`` with ``code`` and ``error`` in the place of ``_v``."""
    trees, cuts = [Gnat(b) for b in books], _cuts(width, len(books))
    digits = max([2, *(len(f"{len(b) - 1:x}") for b in books)])
    names = [c for c in whole.columns if c != "_v"]
    schema = T.StructType([f for f in whole.schema.fields if f.name != "_v"]).add("code", "string").add("error", "long")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, v = _codable(batch.column("_v"), width)
            if not books:
                good[:] = False
            place = np.cumsum(good) - 1
            codes: list = [None] * len(good)
            error = np.zeros(len(good), np.int64)
            if good.any():
                index, own = _assigned(v, trees, cuts)
                error[good] = own
                for i in np.flatnonzero(good):
                    codes[i] = "".join(f"{e:0{digits}x}" for e in index[place[i]])
            columns = [*(batch.column(n) for n in names), pa.array(codes, pa.string()), pa.array(error, mask=~good)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "code", "error"])

    return whole.mapInArrow(name, schema)


def digest(books: Codebooks) -> str:
    """SHA-256 of all entries' components by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def with_group_sum(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``rows`` (settled) with the sum of ``value`` over all rows with the same ``key``, nulls together.

    Keys with more than 1/HOT of all rows, fewer than HOT by count, are joined where the rows
    are; only the rows of the other keys move.
    """
    totals = write_settled(rows.groupBy(F.col(key).alias("_key")).agg(F.sum(value).alias(name), F.count("*").alias("_n")), "totals")
    n = rows.count()
    hot = totals.where(F.col("_n") * HOT > n).select("_key", name, F.lit(True).alias("_hot"))
    marked = rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    mild = marked.where("_hot IS NULL").drop(name, "_hot").join(totals.where(F.col("_n") * HOT <= n).drop("_n"), F.col(key).eqNullSafe(F.col("_key")))
    return marked.where("_hot").drop("_hot").unionByName(mild.drop("_key"))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of each usable vector.

    Needs ``vec_id``, ``embedding`` and ``label``; other columns are ignored. The code has two
    hex digits for each part, the index of its nearest entry; the error is the squared distance
    to these entries, ``label_error`` its sum over all rows of the label (nulls together).
    """
    whole = write_settled(integers(vectors.select("vec_id", "label", "embedding")), "integers")
    books, width = fit(whole, "vec_id", parts, entries, rounds)
    coded = write_settled(encode(whole, books, width), "codes")
    drop_settled(whole)
    found = with_group_sum(coded, "label", "error", "label_error")
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _lloyd(k: int) -> str:
    """One round in SQL: assign parts to the entries of round ``k``, replace those that are used."""
    return f"""
near{k} AS MATERIALIZED (
  SELECT p.row, p.part, any_value(p.v) AS v, min(apart(p.v, c.v) * {ENTRIES} + c.entry) AS best
  FROM pieces p JOIN book{k} c ON p.part = c.part GROUP BY p.row, p.part),
mean{k} AS (
  SELECT part, entry, list(((s - (((s % n) + n) % n)) // n)::BIGINT ORDER BY pos) AS v
  FROM (SELECT part, (best % {ENTRIES}) AS entry, pos, sum(v[pos]) AS s, count(*) AS n
        FROM (SELECT part, best, v, unnest(range(1, len(v) + 1)) AS pos FROM near{k}) GROUP BY ALL) GROUP BY part, entry),
book{k + 1} AS MATERIALIZED (
  SELECT c.part, c.entry, coalesce(m.v, c.v) AS v FROM book{k} c LEFT JOIN mean{k} m USING (part, entry)),"""


SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row, vec_id, label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS MATERIALIZED (
  SELECT row, part, v[part * len(v) // {PARTS} + 1 : (part + 1) * len(v) // {PARTS}] AS v
  FROM (SELECT row, v, unnest(range({PARTS})) AS part FROM kept)),
book0 AS MATERIALIZED (SELECT part, row AS entry, v FROM pieces WHERE row < {ENTRIES}),
{reduce(lambda text, k: text + _lloyd(k), range(ROUNDS), "")}
final AS (
  SELECT p.row, p.part, min(apart(p.v, c.v) * {ENTRIES} + c.entry) AS best
  FROM pieces p JOIN book{ROUNDS} c ON p.part = c.part GROUP BY p.row, p.part),
coded AS (
  SELECT row, string_agg(printf('%02x', (best % {ENTRIES})::INT), '' ORDER BY part) AS code, sum(best // {ENTRIES})::BIGINT AS error
  FROM final GROUP BY row)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM
          (SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS pos FROM book{ROUNDS})) AS codebooks_sha256
FROM kept JOIN coded USING (row)
""".replace("apart(p.v, c.v)", "list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT")

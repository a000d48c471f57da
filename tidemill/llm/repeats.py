"""Removal of long repeated byte strings, by suffix order.

A window of ``length`` bytes is repeated if it also starts elsewhere. To find all of them
without one suffix array over the corpus:

1. *Anchors.* Of the ``CORE``-byte strings in a window the one of least hash (the rightmost of
   equals) is its anchor, so equal windows have equal anchors at the same offset. The windows
   of one anchor begin at neighbouring bytes; together they are one stretch of the text, about
   one anchor for each hundred bytes. Only 64-bit anchor hashes are counted over the corpus.
2. *Stretches.* Anchors that occur twice send their stretch: what stands left and right of
   the core. Equal stretches are collapsed with their number.
3. *Order.* Stretches are gathered by anchor into collections of bounded size, and each
   collection's BWT and common prefixes are built column by column (:mod:`bwt`), the core being
   one symbol that only its own anchor has. A window is the same number of symbols for all, so
   it is repeated if its suffix has that many in common with a neighbour in suffix order, or if
   its stretch was there more than once.
4. An anchor with more different stretches than a collection holds has each of their windows
   grouped by content instead; that needs no bound.
5. Windows go back to their texts, their union is what is removed.

Passages too short to be removed can be shown, by anchors of shorter windows alone: equal windows
have equal anchors, so a shared passage of a window's length has an anchor that stands twice.

Texts are named by 128 bits and kept once, in a table bucketed by that name, so that the two
steps that need them again do not shuffle them. What is removed from a text depends on its
bytes only, so equal texts share the result; if a text occurs twice, all its windows do.
"""

from __future__ import annotations

import atexit
import hashlib
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import drop_settled, write_settled
from . import bwt, textbytes
from .keys import text_key

CORE = 200
COLLECTION = 2_000  # stretches ordered together
HOT = 1_024  # an anchor with more than 1/HOT of all rows is hot: there are fewer than HOT of them
PIECE = 1 << 20  # bytes of one text looked at together (positions take 24 bits)

_TABLES: list[tuple[SparkSession, str]] = []


def anchors_of(data: np.ndarray, starts: np.ndarray, length: int, core: int) -> tuple[np.ndarray, ...]:
    """Anchors of all windows of the texts: text, hash, place of the core, first and last window.

    Places count within their text. ``starts`` from 0.
    """
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    sums = textbytes.prefix_sums(data)
    at = np.arange(len(data) - core + 1)
    hashed = textbytes.hashes(sums, at, at + core)
    span = length - core + 1  # cores in a window
    low = np.uint64((1 << 24) - 1)
    key = (hashed & ~low) | (low - at.astype(np.uint64))  # of equal hashes the rightmost is least
    size = -(-len(key) // span) * span
    padded = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(key)] = key
    blocks = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[span - 1 : span - 1 + n])
    anchor = (low - (least & low)).astype(np.int64)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[:n]
    valid = np.arange(n) + length <= starts[text + 1]
    change = np.ones(n, bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(change & valid)
    group = np.cumsum(change) - 1
    last_of = np.zeros(int(group[-1]) + 1, np.int64)
    own = np.flatnonzero(valid)
    last_of[group[own]] = own
    last = last_of[group[first]]
    text, core_at = text[first], anchor[first]
    begin = starts[text]
    return text, hashed[core_at].astype(np.int64), core_at - begin, first - begin, last - begin


def _pieces(size: int, length: int, piece: int) -> Iterator[tuple[int, int]]:
    """Overlapping pieces of a long text, such that each window lies in exactly one as a start."""
    for begin in range(0, max(1, size - length + 1), piece - length + 1):
        yield begin, min(size, begin + piece)


def _anchor_rows(length: int, core: int, piece: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = textbytes.buffer(batch.column("text"))
            h1, h2 = (np.asarray(batch.column(c)) for c in ("_h1", "_h2"))
            for i, j in textbytes.slices(starts):
                if j == i + 1:
                    parts = [
                        (i, shift, anchors_of(data[starts[i] + shift : starts[i] + end], np.array([0, end - shift]), length, core))
                        for shift, end in _pieces(int(starts[j] - starts[i]), length, piece)
                    ]
                else:
                    parts = [(i, 0, anchors_of(data[starts[i] : starts[j]], starts[i : j + 1] - starts[i], length, core))]
                for base, shift, (text, key, at, first, last) in parts:
                    yield pa.RecordBatch.from_arrays(
                        [*map(pa.array, (key, h1[base + text], h2[base + text], at + shift, first + shift, last + shift))],
                        names=["key", "_h1", "_h2", "at", "first", "last"],
                    )

    return scan


def _mark_rows(length: int, core: int, piece: int):
    """Each anchor once, also if windows of two pieces of a text have it."""
    rows = _anchor_rows(length, core, piece)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edge = None
        for batch in rows(batches):
            batch = batch.select(["key", "_h1", "_h2", "at"])
            if batch.num_rows and batch.slice(0, 1).to_pylist() == edge:
                batch = batch.slice(1)
            if batch.num_rows:
                edge = batch.slice(batch.num_rows - 1).to_pylist()
                yield batch

    return scan


def _stretches(length: int, core: int):
    """Cut the stretch of each anchor out of its text; ``sid`` names anchor and stretch."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for row in range(batch.num_rows):
                text = texts[row].as_py().encode() if isinstance(texts[row].as_py(), str) else texts[row].as_py()
                found = batch.column("anchors")[row].values
                key, at, first, last = (np.asarray(found.field(c)) for c in ("key", "at", "first", "last"))
                left = [text[a:b] for a, b in zip(first, at)]
                right = [text[a + core : b + length] for a, b in zip(at, last)]
                sid = [
                    hashlib.blake2b(b"%d %d " % (k, len(x)) + x + y, digest_size=16).digest()
                    for k, x, y in zip(key.tolist(), left, right)
                ]
                same = lambda c: pa.array(np.full(len(key), batch.column(c)[row].as_py(), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key), pa.array(sid, pa.binary()), pa.array(left, pa.binary()), pa.array(right, pa.binary()),
                        same("_h1"), same("_h2"), pa.array(first),
                    ],
                    names=["key", "sid", "left", "right", "_h1", "_h2", "first"],
                )

    return cut


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "little") ^ int.from_bytes(b[:n], "little")
    return n if x == 0 else ((x & -x).bit_length() - 1) // 8


def _shared(keys: list, parts: list[bytes]) -> list[int]:
    """How much of each part any other part of the same anchor begins with."""
    order = sorted(range(len(keys)), key=lambda i: (keys[i], parts[i]))
    found = [0] * len(keys)
    for i, j in zip(order, order[1:]):
        if keys[i] == keys[j]:
            n = _common(parts[i], parts[j])
            found[i], found[j] = max(found[i], n), max(found[j], n)
    return found


def order_collection(keys, lefts, rights, counts, length: int, core: int) -> list[np.ndarray]:
    """Which windows of each stretch are repeated, from the suffix order of the collection.

    Bytes that no other stretch of the anchor shares, going out from the core, can't be in a
    repeated window; they are left out of the strings that are ordered. Strings that are equal then
    repeat each other whole, one of them is ordered, and none if its anchor has no other.
    """
    number = {k: 257 + i for i, k in enumerate(dict.fromkeys(keys))}
    window = length - core + 1
    before, after = _shared(keys, [x[::-1] for x in lefts]), _shared(keys, rights)
    chosen = [i for i in range(len(keys)) if before[i] + after[i] + 1 >= window]
    symbols = lambda x: np.frombuffer(x, np.uint8).astype(np.uint16) + 1
    alike: dict[tuple, list[int]] = {}
    for i in chosen:
        alike.setdefault((keys[i], lefts[i][len(lefts[i]) - before[i] :], rights[i][: after[i]]), []).append(i)
    different = Counter(k for k, _, _ in alike)
    flags = [np.full(len(x) + len(y) + 2 - window, c > 1) for x, y, c in zip(lefts, rights, counts)]
    for members in alike.values():
        for i in members if len(members) > 1 else ():
            begin = len(lefts[i]) - before[i]
            flags[i][begin : begin + before[i] + after[i] + 2 - window] = True
    ordered = [(k, x, y, members) for (k, x, y), members in alike.items() if different[k] > 1]
    strings = [np.concatenate((symbols(x), [number[k]], symbols(y))).astype(np.uint16) for k, x, y, _ in ordered]
    _, lcp, places = bwt.build(strings)
    near = np.maximum(lcp, np.append(lcp[1:], 0))  # with the nearer neighbour
    for (_, _, _, members), s, p in zip(ordered, strings, places):
        many = len(s) - window + 1
        for i in members:
            begin = len(lefts[i]) - before[i]
            flags[i][begin : begin + many] |= near[p[:many]] >= window
    return flags


def _ordered(length: int, core: int, collection: int):
    """Order the stretches of a partition, sorted by anchor, in collections of whole anchors."""

    def judge(keys, sids, lefts, rights, counts) -> pd.DataFrame:
        flags = order_collection(keys, lefts, rights, counts, length, core)
        out = [(s, int(a), int(b)) for s, f in zip(sids, flags) for a, b in zip(*_runs(f))]
        return pd.DataFrame(out, columns=["sid", "from", "to"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for frame in frames:
            frame = frame.reset_index(drop=True)
            while len(frame):
                room = collection - size
                if len(frame) <= room:
                    held.append(frame)
                    size += len(frame)
                    break
                # end at a change of anchor at or before the room's end
                keys = np.concatenate([*[h["key"].to_numpy() for h in held], frame["key"].to_numpy()[: room + 1]])
                cut = int(np.flatnonzero(keys[1:] != keys[:-1])[-1]) + 1 if (keys[1:] != keys[:-1]).any() else len(keys) - 1
                both = pd.concat([*held, frame], ignore_index=True)
                part, frame = both.iloc[:cut], both.iloc[cut:].reset_index(drop=True)
                held, size = [], 0
                yield judge(*(part[c].tolist() for c in ("key", "sid", "left", "right", "m")))
        if held:
            part = pd.concat(held, ignore_index=True)
            yield judge(*(part[c].tolist() for c in ("key", "sid", "left", "right", "m")))

    return run


def _windows(length: int, core: int):
    """Every window of a stretch, named by its content, its place in the stretch with it."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, sid, left, right, m in zip(*(batch.column(c).to_pylist() for c in ("key", "sid", "left", "right", "m"))):
                n = len(left) + core + len(right) - length + 1
                names = [
                    hashlib.blake2b(b"%d %d " % (key, len(left) - i) + left[i:] + right[: length - core - len(left) + i], digest_size=16).digest()
                    for i in range(n)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.binary()), pa.array([sid] * n, pa.binary()), pa.array(range(n), pa.int64()), pa.array([m] * n, pa.int64())],
                    names=["window", "sid", "from", "m"],
                )

    return each


def _union(begin: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the maximal runs that strings of one size cover, given their begins."""
    begin = np.sort(begin)
    fresh = np.ones(len(begin), bool)
    fresh[1:] = begin[1:] > begin[:-1] + size
    return begin[fresh], begin[np.append(fresh[1:], True)] + size


def _spans(length: int, least: int, mark: int):
    """What remains of each text: bytes, removed bytes, removed runs, checksum of the rest; and the bytes
    that marks cover (all, if a text of ``least`` bytes or more occurs twice)."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = textbytes.buffer(batch.column("text"))
            rows = []
            for row in range(batch.num_rows):
                text = data[starts[row] : starts[row + 1]]
                size = len(text)
                runs, marks, twice = batch.column("runs")[row], batch.column("marks")[row], batch.column("m")[row].as_py() > 1
                if twice and size >= least:
                    shared = size
                elif marks.is_valid and len(marks.values):
                    first, after = _union(np.asarray(marks.values), mark)
                    shared = int((after - first).sum())
                else:
                    shared = 0
                if twice and size >= length:
                    begin, end = np.zeros(1, np.int64), np.full(1, size)
                elif runs.is_valid and len(runs.values):
                    found = runs.values
                    begin = np.asarray(found.field("begin"))
                    order = np.argsort(begin, kind="stable")
                    begin, end = begin[order], np.maximum.accumulate(np.asarray(found.field("end"))[order] + length)
                    fresh = np.ones(len(begin), bool)
                    fresh[1:] = begin[1:] > end[:-1]
                    begin, end = begin[fresh], end[np.append(np.flatnonzero(fresh)[1:] - 1, len(end) - 1)]
                else:
                    begin = end = np.zeros(0, np.int64)
                kept = hashlib.sha256()
                for a, b in zip(np.append(0, end), np.append(begin, size)):
                    kept.update(text[a:b])
                rows.append((size, int((end - begin).sum()), begin, end, kept.hexdigest(), shared))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_h1"), batch.column("_h2"),
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.list_(pa.int64())), pa.array([r[3] for r in rows], pa.list_(pa.int64())),
                    pa.array([r[4] for r in rows], pa.string()), pa.array([r[5] for r in rows], pa.int64()),
                ],
                names=["_h1", "_h2", "n_bytes", "n_removed", "begins", "ends", "kept_sha256", "n_shared"],
            )

    return close


def _bucketed(df: DataFrame, *keys: str) -> DataFrame:
    """Write a table bucketed by its keys; joins on them then leave its rows where they are.

    It stays until the application ends or :func:`_drop_table`.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"texts_{uuid.uuid4().hex}"
    df.repartition(n, *keys).write.bucketBy(n, *keys).format("parquet").saveAsTable(name)
    _TABLES.append((spark, name))
    found = spark.table(name)
    found._table_name = name
    return found


def _drop_table(table: DataFrame) -> None:
    table.sparkSession.sql(f"DROP TABLE IF EXISTS {table._table_name}")
    _TABLES[:] = [t for t in _TABLES if t[1] != table._table_name]


@atexit.register
def _drop_tables() -> None:
    for spark, name in _TABLES:
        if spark.sparkContext._jsc is not None:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    _TABLES.clear()


def _hot(counts: DataFrame, rows: int) -> Column:
    """Whether ``key`` has more than 1/HOT of all rows: fewer than HOT keys, whose rows then stay where they are."""
    keys = [k for (k,) in counts.where(F.col("n") * HOT > rows).select("key").collect()]
    return F.col("key").isin(keys) if keys else F.lit(False)


def _standing_twice(anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The anchors whose ``key`` occurs twice or more, and the settled table of those keys."""
    twice = write_settled(anchors.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "twice")
    hot = _hot(twice, anchors.count())
    return anchors.where(hot).union(anchors.where(~hot).join(twice.where(~hot).select("key"), "key", "left_semi")), twice


def _marks(texts: DataFrame, least: int, piece: int) -> DataFrame:
    """For each text with any, where anchors of windows of ``least`` bytes begin that stand twice or more."""
    rows = texts.where(F.octet_length("text") >= least).select("_h1", "_h2", "text")
    marks = write_settled(rows.mapInArrow(_mark_rows(least, least // 2, piece), "key long, _h1 long, _h2 long, at long"), "marks")
    found, twice = _standing_twice(marks)
    found = write_settled(found.groupBy("_h1", "_h2").agg(F.collect_list("at").alias("marks")), "marked")
    drop_settled(marks, twice)
    return found


def repeated_spans(
    docs: DataFrame, length: int = 400, core: int = CORE, collection: int = COLLECTION, piece: int = PIECE, shown: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """The distinct texts (``_h1``, ``_h2``, ``text``, ``m`` rows) and what is removed from each
    (``n_bytes``, ``n_removed``, ``begins`` and ``ends`` of the removed runs, ``kept_sha256``).

    With ``shown``, ``n_shared`` counts the bytes under anchors, strings of half that length, that
    stand twice or more; it is above 0 in each text that shares a string of ``shown`` bytes.
    """
    texts = docs.select(*text_key(), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    texts = _bucketed(texts.groupBy("_h1", "_h2").agg(F.first("text").alias("text"), F.count("*").alias("m")), "_h1", "_h2")
    marks = _marks(texts, shown, piece) if shown else None
    long = texts.where(F.octet_length("text") >= length)
    anchors = write_settled(
        long.select("_h1", "_h2", "text").mapInArrow(
            _anchor_rows(length, core, piece), "key long, _h1 long, _h2 long, at long, first long, last long"
        ),
        "anchors",
    )
    found, twice = _standing_twice(anchors)
    by_text = found.groupBy("_h1", "_h2").agg(F.collect_list(F.struct("key", "at", "first", "last")).alias("anchors"))
    pieces = write_settled(
        texts.select("_h1", "_h2", "text").join(by_text, ["_h1", "_h2"]).mapInArrow(
            _stretches(length, core), "key long, sid binary, left binary, right binary, _h1 long, _h2 long, first long"
        ),
        "stretches",
    )
    drop_settled(anchors, twice)
    distinct = pieces.groupBy("key", "sid").agg(F.first("left").alias("left"), F.first("right").alias("right"), F.count("*").alias("m"))
    distinct = write_settled(distinct, "distinct")
    per_key = write_settled(distinct.groupBy("key").agg(F.count("*").alias("n")), "per-key")
    hot = _hot(per_key.where(F.col("n") > collection), distinct.count())
    counted = distinct.where(~hot).join(per_key.where(~hot), "key")
    crowded = distinct.where(hot).withColumn("n", F.lit(collection + 1).cast("long"))
    # Stretches that are alone with their anchor are ordered by their number alone.
    alone = counted.where("n = 1 AND m > 1").select(
        "sid", F.lit(0).cast("long").alias("from"),
        (F.octet_length("left") + F.octet_length("right") + F.lit(core - length)).cast("long").alias("to"),
    )
    several = counted.where(F.col("n").between(2, collection)).drop("n")
    judged = several.repartition("key").sortWithinPartitions("key").mapInPandas(
        _ordered(length, core, collection), "sid binary, from long, to long"
    )
    many = counted.where(F.col("n") > collection).unionByName(crowded).drop("n").mapInArrow(
        _windows(length, core), "window binary, sid binary, from long, m long"
    )
    again = many.groupBy("window").agg(F.sum("m").alias("_n")).where("_n > 1")
    spread = many.join(again, "window").select("sid", "from")
    island = F.col("from") - F.row_number().over(Window.partitionBy("sid").orderBy("from"))  # a stretch's windows: few
    spread = spread.withColumn("_island", island).groupBy("sid", "_island")
    spread = spread.agg(F.min("from").alias("from"), F.max("from").alias("to")).drop("_island")
    runs = alone.union(judged).union(spread).groupBy("sid").agg(F.collect_list(F.struct("from", "to")).alias("runs"))
    runs = write_settled(runs, "runs")
    moved = F.transform("runs", lambda r: F.struct((F.col("first") + r["from"]).alias("begin"), (F.col("first") + r["to"]).alias("end")))
    placed = pieces.select("sid", "_h1", "_h2", "first").join(runs, "sid").select("_h1", "_h2", moved.alias("runs"))
    placed = placed.groupBy("_h1", "_h2").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    results = texts.join(placed, ["_h1", "_h2"], "left")
    if shown:
        results = results.join(marks, ["_h1", "_h2"], "left")
    else:
        results = results.withColumn("marks", F.lit(None).cast("array<long>"))
    results = results.mapInArrow(
        _spans(length, shown or length, (shown or length) // 2),
        "_h1 long, _h2 long, n_bytes long, n_removed long, begins array<long>, ends array<long>, kept_sha256 string, n_shared long",
    )
    results = write_settled(results, "removed")
    drop_settled(distinct, per_key, pieces, runs, *([marks] if shown else []))
    return texts, results


def deduplicated(
    docs: DataFrame, length: int = 400, core: int = CORE, collection: int = COLLECTION, piece: int = PIECE, shown: int | None = None
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` for each row.

    With ``shown`` also ``n_shared``, which shows passages of that many bytes that stay: 0 if no
    string of ``shown`` bytes also stands elsewhere; if above 0, strings of half of it do, and it
    counts the bytes under those of them that are anchors.

    Needs ``doc_id`` and ``text``; other columns are ignored. A null text is empty. Texts
    shorter than ``length`` lose nothing. Repeated rows repeat each other, so all their windows
    are removed. A null ``doc_id`` is kept. An empty table gives an empty result.
    """
    texts, results = repeated_spans(docs, length, core, collection, piece, shown)
    _drop_table(texts)
    more = ["n_shared"] if shown else []
    named = results.select("_h1", "_h2", "n_bytes", "n_removed", F.size("begins").cast("long").alias("n_spans"), "kept_sha256", *more)
    return docs.select("doc_id", *text_key()).join(named, ["_h1", "_h2"]).drop("_h1", "_h2")


def without_repeats(docs: DataFrame, length: int = 400, core: int = CORE) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text`` (and ``n_chars``, if there, counted anew).

    What is left is read as UTF-8 again; a character cut in two loses its other half. Rows
    whose whole text is removed stay, with an empty text; a null text stays null.
    """
    texts, results = repeated_spans(docs, length, core)

    @F.pandas_udf("string")
    def cut(text: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.Series:
        def one(t, b, e):
            if b is None or not len(b):
                return t
            raw = t.encode()
            return b"".join(raw[x:y] for x, y in zip([0, *e], [*b, len(raw)])).decode("utf-8", "ignore")

        return pd.Series([one(*x) for x in zip(text, begins, ends)], dtype=object)

    left = texts.select("_h1", "_h2", "text").join(results.select("_h1", "_h2", "begins", "ends"), ["_h1", "_h2"])
    left = left.select("_h1", "_h2", cut("text", "begins", "ends").alias("_left"))
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others, F.col("text").isNull().alias("_no_text")).alias("_doc"), *text_key())
    joined = rows.join(left, ["_h1", "_h2"])
    text = F.when(~F.col("_doc._no_text"), F.col("_left"))
    fields = {c: F.col("_doc")[c] for c in others} | {"text": text}
    if "n_chars" in fields:
        kind = docs.schema["n_chars"].dataType
        fields["n_chars"] = F.when(F.col("_doc._no_text"), fields["n_chars"]).otherwise(F.char_length("_left").cast(kind))
    return joined.select(*(fields[c].alias(c) for c in docs.columns))

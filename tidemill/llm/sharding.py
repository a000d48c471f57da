"""Sharding by the minimax contiguous partition of ordered atomic groups.

Groups are rows of equal text, in the order of the text's SHA-256, so that a contiguous
part of the order is also a random part of the corpus. The smallest capacity with which a
greedy pass fills all groups into the shards is found by binary search, and the order is cut
there. The search sees group boundaries only where it needs them: it starts with the two
ends, brackets the capacity from what is known (cuts at known boundaries can be done, cuts
anywhere can't be beaten), and asks the table for at most ``DETAIL`` further boundaries in
the stretches where a cut may still fall. It ends when both brackets agree, which is exact.

Cutting: with the capacity settled, each shard stops at the boundary nearest above an equal
share of what is left, if that keeps to the capacity and leaves the rest feasible; so a
group larger than a fair share does not leave other shards empty.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_settled, write_settled
from .order import END, ROW, positions

DETAIL = 8_192  # boundaries asked for at a time: what the driver holds of the table
OVERHEAD = 8


class _Order:
    """What the driver knows of the ordered groups: ends of some of them.

    ``ends[i]`` is a running size at which a group ends, ``rows[i]`` the rows up to there,
    ``open[i]`` whether further groups may end between it and the one before.
    """

    def __init__(self, total: int, rows: int):
        self.ends, self.rows, self.open = [0, total], [0, rows], [False, True]

    def add(self, found: list[tuple[int, int, int, int, int]], windows: list[tuple[int, int]]) -> None:
        """Take in the first and last group end and their count, for each slice of the windows."""
        known = {e: (r, o) for e, r, o in zip(self.ends, self.rows, self.open)}
        for low, high in windows:  # nothing else ends in there
            i = bisect_right(self.ends, low)
            while i < len(self.ends) and self.ends[i] <= high:
                known[self.ends[i]] = (self.rows[i], False)
                i += 1
        for first, first_row, last, last_row, n in found:
            known[last] = (last_row, n > 2)
            if first != last:
                known[first] = (first_row, False)
        ordered = sorted(known.items())
        self.ends = [e for e, _ in ordered]
        self.rows = [r for _, (r, _) in ordered]
        self.open = [o for _, (_, o) in ordered]

    def gap(self, at: int) -> int:
        """Index of the known end at or above ``at``."""
        return bisect_left(self.ends, at)

    def reach(self, start: int, capacity: int, hopeful: bool) -> int:
        """How far a shard from ``start`` gets; hopeful: as if groups ended anywhere in open gaps."""
        target = start + capacity
        if target >= self.ends[-1]:
            return self.ends[-1]
        i = bisect_right(self.ends, target) - 1
        return target if hopeful and self.open[i + 1] else self.ends[i]

    def walk(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        cuts, at = [], 0
        for _ in range(shards):
            at = self.reach(at, capacity, hopeful)
            cuts.append(at)
        return cuts

    def least(self, shards: int, hopeful: bool) -> int:
        total = self.ends[-1]
        low, high = -(-total // shards), total
        while low < high:
            middle = (low + high) // 2
            if self.walk(middle, shards, hopeful)[-1] >= total:
                high = middle
            else:
                low = middle + 1
        return low

    def cuts(self, capacity: int, shards: int) -> list[int]:
        """Ends of the shards, at known ends, none above the capacity, as equal as that allows."""
        total = self.ends[-1]
        latest = [total]  # least start from which the last k shards can hold the rest
        for _ in range(shards - 1):
            latest.append(self.ends[bisect_left(self.ends, latest[-1] - capacity)] if latest[-1] > capacity else 0)
        at, found = 0, []
        for left in range(shards, 0, -1):
            share = at + -(-(total - at) // left)
            limit = self.ends[bisect_right(self.ends, at + capacity) - 1]
            least = latest[left - 1] if left > 1 else total
            at = min(max(self.ends[bisect_left(self.ends, share)], least), limit)
            found.append(at)
        return found


def _windows(order: _Order, stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The open gaps that the stretches touch, merged."""
    gaps = set()
    for low, high in stretches:
        for i in range(order.gap(low), min(order.gap(high) + 1, len(order.ends) - 1) + 1):
            if i and order.open[i]:
                gaps.add((order.ends[i - 1], order.ends[i]))
    merged: list[tuple[int, int]] = []
    for low, high in sorted(gaps):
        if merged and merged[-1][1] == low:
            merged[-1] = (merged[-1][0], high)
        else:
            merged.append((low, high))
    return merged


def _ask(ends: DataFrame, windows: list[tuple[int, int]], detail: int) -> list[tuple]:
    """First and last group end of each slice of the windows: at most ``detail`` slices, or one a window.

    Tasks look slices up in the sorted bounds, so neither plan nor cost a row grows with the windows.
    """
    each = max(1, detail // len(windows))
    low, high = (np.array(x, np.int64) for x in zip(*windows))
    width = np.maximum(1, -(-(high - low) // each))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            end, row = (np.asarray(batch.column(c), np.int64) for c in (END, ROW))
            at = np.searchsorted(low, end) - 1  # the last window that begins below
            inside = (at >= 0) & (end <= high[at])
            end, row, at = end[inside], row[inside], at[inside]
            number = at * each + (end - low[at] - 1) // width[at]
            order = np.lexsort((end, number))
            end, row, number = end[order], row[order], number[order]
            first = np.flatnonzero(np.diff(number, prepend=-1))
            last = np.append(first[1:], len(number)) - 1 if len(first) else first
            columns = [number[first], end[first], row[first], end[last], row[last], last - first + 1]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["slice", "a", "a_row", "b", "b_row", "n"])

    found = (
        ends.select(END, ROW)
        .mapInArrow(look, "slice long, a long, a_row long, b long, b_row long, n long")
        .groupBy("slice")
        .agg(F.min("a"), F.min("a_row"), F.max("b"), F.max("b_row"), F.sum("n"))
    )
    return [(a, b + 1, c, d + 1, n) for _, a, b, c, d, n in found.collect()]


def shard(docs: DataFrame, shards: int = 24, detail: int = DETAIL) -> DataFrame:
    """Each row's ``shard``, its ``slot`` there (gapless from 0) and the digests it follows from.

    Needs ``doc_id`` and ``text``; other columns are ignored. Size: UTF-8 bytes of the text
    plus 8. A null text has no bytes and groups with the empty one (checksum 0). Repeated rows
    are rows of their own in one group. A null ``doc_id`` is kept and comes last in its group.
    Fewer groups than shards leave shards empty; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = write_settled(
        docs.select(
            "doc_id",
            (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
            F.crc32(text).cast("long").alias("text_crc32"),
            F.sha2(text, 256).alias("_group"),
        ),
        "sizes",
    )
    placed = positions(rows, [F.col("_group"), F.col("doc_id")], "size")
    drop_settled(rows)
    # A group ends at its last row; partial sums keep this small even for a group of a third of all rows.
    ends = write_settled(placed.groupBy("_group").agg(F.max(END).alias(END), F.max(ROW).alias(ROW)), "ends")
    total, n = ends.agg(F.max(END), F.max(ROW)).first()
    cuts, starts = [0] * shards, [0] * shards
    if total:
        order = _Order(total, n + 1)
        while True:
            low, high = order.least(shards, True), order.least(shards, False)
            if low == high:
                chosen = order.cuts(high, shards)
                before = [0, *chosen[:-1]]
                shares = [b + -(-(total - b) // (shards - k)) for k, b in enumerate(before)]
                asked = _windows(order, [(s, s) for s in shares if s < total])
            else:
                asked = _windows(
                    order, list(zip(order.walk(low, shards, False), order.walk(high, shards, True)))
                )
            if not asked:
                break
            order.add(_ask(ends, asked, detail), asked)
        row_at = dict(zip(order.ends, order.rows))
        cuts, starts = chosen, [0, *(row_at[c] for c in chosen[:-1])]
    number = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts[:-1]]), lambda c: c < F.col(END)))
    first = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), F.col("shard") + 1)
    drop_settled(ends)
    return (
        placed.withColumn("shard", number.cast("int"))
        .withColumn("slot", F.col(ROW) - first)
        .withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})
        .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    )

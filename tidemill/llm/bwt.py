"""Column-wise construction of the BWT and common prefixes of many strings.

All strings grow to the left together: round j inserts the suffix of length j of every
string that has one, that is one symbol for each string. A suffix c s stands, among the
suffixes that begin with c, where this c stands among the c's of the transform; so its
place follows from the transform as the round before left it, and the new transform and the
new common-prefix lengths are the old ones read in order with the new entries put in
between. Both live in two files that each round reads from front to back and writes anew;
in memory stay a cursor for each string and one round's working arrays.

The common prefix of c s and its neighbour c s' is one longer than that of s and s', which
is the least of the lengths between them. Ranges between equal symbols are short, as many as
there are different symbols on average.
"""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

import numpy as np


def _least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For low < high, the least of values[low + 1 .. high]; ranges of one symbol don't overlap."""
    if not len(low):
        return np.zeros(0, values.dtype)
    ends = np.empty(2 * len(low), np.int64)
    ends[::2], ends[1::2] = low + 1, high + 1
    ends[-1:] = np.minimum(ends[-1:], len(values))
    padded = np.append(values, values[-1:])  # an end may be the end of the array
    return np.minimum.reduceat(padded, ends)[::2]


def build(strings: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Transform, common-prefix lengths, and the place of each suffix.

    ``strings`` are arrays of symbols from 1 to 65535. The transform has 0 where a string
    begins. ``lcp[i]`` is the common prefix of the suffixes at i - 1 and i (ends of strings are
    all different). ``places[k][o]`` is the place of the suffix of string k that begins at o,
    up to o = its length (the empty suffix). Lengths must be below 32767.
    """
    n = len(strings)
    sizes = np.array([len(s) for s in strings], np.int64)
    longest = int(sizes.max(initial=0))
    ends = np.concatenate(([0], np.cumsum(sizes)))
    text = np.concatenate(strings).astype(np.uint16) if n else np.zeros(0, np.uint16)

    def symbols(active: np.ndarray, done: int) -> np.ndarray:
        """What precedes the suffix of length ``done``; 0 at the string's begin."""
        at = ends[1:][active] - done - 1
        return np.where(sizes[active] > done, text[np.maximum(at, 0)] if len(text) else 0, 0).astype(np.uint16)

    with tempfile.TemporaryFile() as bwt_file, tempfile.TemporaryFile() as lcp_file:

        def put(bwt: np.ndarray, lcp: np.ndarray) -> None:
            for file, values in ((bwt_file, bwt), (lcp_file, lcp)):
                file.seek(0)
                file.write(memoryview(np.ascontiguousarray(values)).cast("B"))
                file.truncate()

        def get() -> tuple[np.ndarray, np.ndarray]:
            bwt_file.seek(0)
            lcp_file.seek(0)
            return np.frombuffer(bwt_file.read(), np.uint16), np.frombuffer(lcp_file.read(), np.int16)

        active = np.arange(n)
        at = np.arange(n)  # where each string's last suffix stands
        put(symbols(active, 0), np.zeros(n, np.int16))
        for done in range(longest):
            bwt, lcp = get()
            going = sizes[active] > done
            active, at = active[going], at[going]
            order = np.argsort(bwt, kind="stable").astype(np.int32)  # where each symbol stands, in order
            counts = np.bincount(bwt)
            begins = np.cumsum(counts) - counts
            c = bwt[at]
            # A symbol's place in order: past its symbol's begin as many as stand before it.
            by_place = np.argsort(c.astype(np.int64) * (len(bwt) + 1) + at)
            active, at, c = active[by_place], at[by_place], c[by_place]
            k = np.empty(len(at), np.int64)
            edges = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(c)]):
                x = int(c[a])
                k[a:b] = begins[x] + np.searchsorted(order[begins[x] : begins[x] + counts[x]], at[a:b])
            zeros = int(counts[0])
            new = k - zeros + n  # the n empty suffixes stand first
            # Common prefixes with the neighbours that begin with the same symbol.
            size = len(bwt) + len(new)
            before = np.zeros(len(new), np.int16)
            same = k > begins[c]
            before[same] = _least(lcp, order[k[same] - 1], at[same]) + 1
            after = np.zeros(len(new), np.int16)
            same = k + 1 < begins[c] + counts[c]
            after[same] = _least(lcp, at[same], order[k[same] + 1]) + 1
            # Old and new merged in one pass.
            old = np.ones(size, bool)
            old[new] = False
            next_bwt = np.empty(size, np.uint16)
            next_lcp = np.empty(size, np.int16)
            next_bwt[old], next_lcp[old] = bwt, lcp
            next_bwt[new] = symbols(active, done + 1)
            inner = new + 1 < size
            next_lcp[new[inner] + 1] = after[inner]
            next_lcp[new] = before
            put(next_bwt, next_lcp)
            at = new
        bwt, lcp = get()

    # Every suffix's place, by following the transform from each string's end.
    order = np.argsort(bwt, kind="stable")
    rank = np.empty(len(bwt), np.int64)
    rank[order] = np.arange(len(bwt))
    shift = n - int(np.count_nonzero(bwt == 0))
    all_places = np.empty(len(text) + n, np.int64)
    base = ends[:-1] + np.arange(n)  # each string has a place more than symbols
    at, active = np.arange(n), np.arange(n)
    for done in range(longest + 1):
        all_places[base[active] + sizes[active] - done] = at
        going = sizes[active] > done
        active, at = active[going], at[going]
        at = rank[at] + shift
    return bwt, lcp, [all_places[b : b + s + 1] for b, s in zip(base, sizes)]

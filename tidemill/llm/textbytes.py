"""Vectorised work on the bytes of many texts at once: rolling hashes, words, shingles.

Texts come as one byte buffer with the offsets at which each begins (as Arrow holds them).
Callers cut a batch with :func:`slices` first, so that memory does not grow with the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE = 1 << 19  # bytes of text worked on at a time; one longer text is a slice of its own
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string array, and where each text begins (one more at the end)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    filled = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    _, starts, data = filled.buffers()
    starts = np.frombuffer(starts, np.int64 if wide else np.int32)[filled.offset : filled.offset + len(filled) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, starts.astype(np.int64)


def slices(starts: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs of texts [i, j) of about ``size`` bytes, a text at least."""
    i, n = 0, len(starts) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    both = []
    for base in (_BASE, _INVERSE):
        p = np.full(n + 1, base, U64)
        p[0] = 1
        both.append(np.multiply.accumulate(p))
    return both[0], both[1]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] = B^i times the polynomial of data[i:j], modulo 2^64."""
    n = len(data)
    up, _ = _powers(max(2 * SLICE, 1 << int(n).bit_length()))
    sums = np.zeros(n + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[:n], out=sums[1:])
    return sums


def hashes(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[begin:end], the same wherever the bytes stand."""
    _, down = _powers(max(2 * SLICE, 1 << int(len(sums) - 1).bit_length()))
    return mixed((sums[end] - sums[begin]) * down[begin])


def words(data: np.ndarray, starts: np.ndarray, gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each lower-cased word, the text it is in, and its end; ``starts`` from 0.

    ``gap`` says for each byte value whether it stands between words.
    """
    low = _LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~gap[data]
    first = inside[1:] & ~inside[:-1]  # a word begins
    last = inside[:-1] & ~inside[1:]  # a word has ended
    edge = starts[1:-1]  # texts end words too
    cut = edge[inside[edge] & inside[edge + 1]] if len(edge) else edge
    first[cut] = True
    last[cut] = True
    begin, end = np.flatnonzero(first), np.flatnonzero(last)
    text = np.searchsorted(starts, begin, "right") - 1
    return hashes(prefix_sums(low), begin, end), text, end


def shingle_sets(data: np.ndarray, starts: np.ndarray, k: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``k`` words.

    Fewer words: the whole sequence is the one shingle. No words: empty.
    """
    hashed, text, _ = words(data, starts)
    n = len(starts) - 1
    count = np.bincount(text, minlength=n)
    at = np.concatenate(([0], np.cumsum(count)))
    size = max(0, len(hashed) - k + 1)
    rolled = np.zeros(size, U64)
    for i in range(k):
        rolled = rolled * U64(0xD6E8FEB86659FD93) + hashed[i : i + size]
    rolled = mixed(rolled + U64(k))
    found = []
    for i in range(n):
        a, b = at[i], at[i + 1]
        if b - a >= k:
            found.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            one = np.full(1, b - a, U64)
            for h in hashed[a:b]:
                one = mixed(one * U64(0xD6E8FEB86659FD93) + h)
            found.append(one)
        else:
            found.append(np.zeros(0, U64))
    return found

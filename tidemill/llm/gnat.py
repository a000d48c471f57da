"""Nearest neighbours among integer points by a geometric near-neighbour access tree.

A node holds up to ``DEGREE`` split points and gives every further point to the child of its
nearest split. For each pair of a split and a child it stores the least and the greatest
distance from the split to the child's points. A query that knows its distance to a split, and
a point within r, can leave out every child whose range lies wholly outside [d - r, d + r].

Distances are compared as integers. Ranges are compared in floating point, widened by more
than all rounding, and strictly, so a point at the same distance as the best is never left out;
among equal distances the lowest index wins.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

DEGREE = 16
LEAF = 8
EXACT = 1 << 53  # integers below this are exact as floating point numbers
_WIDER = 1e-12  # relative; rounding of a conversion, a root and two sums stays below 1e-15
_FAR = np.iinfo(np.int64).max


@dataclass
class _Node:
    points: np.ndarray  # indices of the splits, or of all points of a leaf, ascending
    children: list = field(default_factory=list)  # None where no further point is nearest to the split
    low: np.ndarray | None = None  # [split, child]
    high: np.ndarray | None = None


def square_distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows, as int64; they must fit (``4 * width * max ** 2 < 2 ** 63``)."""
    width = queries.shape[1]
    largest = max((int(np.abs(x).max()) if x.size else 0 for x in (queries, points)))
    if 4 * width * largest * largest < EXACT:
        q, p = queries.astype(float), points.astype(float)
        return ((q * q).sum(1)[:, None] - 2 * (q @ p.T) + (p * p).sum(1)).astype(np.int64)
    found = np.zeros((len(queries), len(points)), np.int64)
    for i in range(width):
        gap = queries[:, i, None].astype(np.int64) - points[None, :, i].astype(np.int64)
        found += gap * gap
    return found


class Gnat:
    """A tree over the rows of ``points`` (integers). ``asked`` counts the distances computed for queries."""

    def __init__(self, points: np.ndarray, degree: int = DEGREE, leaf: int = LEAF):
        self.points = np.asarray(points, np.int64)
        self.degree, self.leaf, self.asked = degree, leaf, 0
        self.root = self._build(np.arange(len(self.points)))

    def _build(self, members: np.ndarray) -> _Node:
        if len(members) <= self.leaf + self.degree:
            return _Node(members)
        # Splits: each the point farthest from those before, the first the lowest index.
        chosen = [0]
        nearest = square_distances(self.points[members], self.points[members[:1]])[:, 0]
        while len(chosen) < self.degree and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, square_distances(self.points[members], self.points[members[chosen[-1:]]])[:, 0])
        if len(chosen) == 1:  # all points are equal, the lowest index answers for all
            return _Node(members[:1])
        splits = np.sort(members[chosen])
        rest = np.setdiff1d(members, splits)
        apart = square_distances(self.points[rest], self.points[splits])
        owner = apart.argmin(1)
        roots = np.sqrt(apart.astype(float))
        node = _Node(splits, [], np.full((len(splits),) * 2, np.inf), np.full((len(splits),) * 2, -np.inf))
        for j in range(len(splits)):
            inside = owner == j
            if not inside.any():
                node.children.append(None)
                continue
            node.low[:, j] = roots[inside].min(0) * (1 - _WIDER)
            node.high[:, j] = roots[inside].max(0) * (1 + _WIDER)
            node.children.append(self._build(rest[inside]))
        return node

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each query's nearest point, the lowest index among equals."""
        queries = np.asarray(queries, np.int64)
        best = np.full(len(queries), _FAR, np.int64)
        index = np.full(len(queries), len(self.points), np.int64)
        if len(queries):
            self._visit(self.root, np.arange(len(queries)), queries, best, index)
        return index, best

    def _visit(self, node: _Node, rows: np.ndarray, queries: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        apart = square_distances(queries[rows], self.points[node.points])
        self.asked += apart.size
        first = apart.argmin(1)  # the lowest index among equals, as points ascend
        least, at = apart[np.arange(len(rows)), first], node.points[first]
        closer = (least < best[rows]) | ((least == best[rows]) & (at < index[rows]))
        best[rows[closer]], index[rows[closer]] = least[closer], at[closer]
        if not node.children:
            return
        roots = np.sqrt(apart.astype(float))
        for own in (True, False):  # the nearest split's child first: it shortens the radius for the others
            for j, child in enumerate(node.children):
                if child is None:
                    continue
                here = np.flatnonzero((first == j) == own)
                reach = np.sqrt(best[rows[here]].astype(float))[:, None]
                d = roots[here]
                slack = (d + reach) * _WIDER
                outside = (d - reach - slack > node.high[:, j]) | (d + reach + slack < node.low[:, j])
                here = here[~outside.any(1)]
                if len(here):
                    self._visit(child, rows[here], queries, best, index)

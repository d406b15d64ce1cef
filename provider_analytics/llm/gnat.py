"""A geometric near-neighbour access tree over the entries of one codebook.

A node keeps split points and, for every split point and child, the smallest and largest
distance from the point to an entry of the child. A query knows its distances to the split
points; a child whose range leaves only larger distances than the best so far is passed
over with all below it. Ranges are widened and differences compared strictly, so that
rounding never passes over an entry that is as near as the best; the answer itself
compares whole numbers, ties going to the lower index.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Split points of a node; nodes of no more entries than twice that are lists.
SPLITS = 12
#: Far above the relative error of a square root and a difference of doubles.
SLACK = 1e-9
#: Sums of products below this are whole numbers in a double.
EXACT = 2.0**52


@dataclass
class Node:
    #: Indexes of the split points, or of all entries of a list, ascending.
    points: np.ndarray
    children: list[Node | None] = field(default_factory=list)
    #: Distances from split point (row) to the entries of a child (column).
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def squared(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of whole-number vectors as int64, each query by each point."""
    if not queries.shape[1]:
        return np.zeros((len(queries), len(points)), np.int64)
    most = float(max(np.abs(queries).max(initial=0), np.abs(points).max(initial=0)))
    if queries.shape[1] * (2 * most) ** 2 < EXACT:
        q, p = queries.astype(float), points.astype(float)
        found = (q * q).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * (q @ p.T)
        return found.astype(np.int64)
    found = np.zeros((len(queries), len(points)), np.int64)
    for at in range(queries.shape[1]):
        apart = queries[:, at, None] - points[None, :, at]
        found += apart * apart
    return found


def _spread(entries: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Split points far from each other: each the farthest from those before it."""
    chosen = [0]
    nearest = squared(entries[among], entries[among[:1]])[:, 0]
    while len(chosen) < SPLITS and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(entries[among], entries[among[chosen[-1:]]])[:, 0])
    return np.sort(among[chosen])


class Gnat:
    """``entries``: int64 vectors, one a row. ``compared`` counts distances worked out."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.compared = 0
        self.root = self._node(np.arange(len(entries)))

    def _node(self, among: np.ndarray) -> Node:
        points = _spread(self.entries, among) if len(among) > 2 * SPLITS else among
        if len(points) in (1, len(among)):
            return Node(among)  # few entries, or all of them equal
        rest = np.setdiff1d(among, points)
        of = squared(self.entries[rest], self.entries[points]).argmin(1)
        node = Node(points)
        node.low = np.full((len(points), len(points)), np.inf)
        node.high = np.full((len(points), len(points)), -np.inf)
        for child in range(len(points)):
            members = rest[of == child]
            node.children.append(self._node(members) if len(members) else None)
            if len(members):
                apart = np.sqrt(squared(self.entries[points], self.entries[members]).astype(float))
                node.low[:, child] = apart.min(1) * (1 - SLACK)
                node.high[:, child] = apart.max(1) * (1 + SLACK)
        return node

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of each query's nearest entry, the lowest of several, and the squared
        distance."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        index = np.full(len(queries), len(self.entries))
        if len(queries):
            self._visit(self.root, queries, np.arange(len(queries)), best, index)
        return index, best

    def _visit(self, node, queries, active, best, index):
        found = squared(queries[active], self.entries[node.points])
        self.compared += found.size
        at = found.argmin(1)
        value, entry = found[np.arange(len(active)), at], node.points[at]
        better = (value < best[active]) | ((value == best[active]) & (entry < index[active]))
        best[active[better]], index[active[better]] = value[better], entry[better]
        if not node.children:
            return
        apart = np.sqrt(found.astype(float))
        # First the child of the nearest split point, then the others, with the best known then.
        for own in (True, False):
            for child, below in enumerate(node.children):
                if below is None:
                    continue
                chosen = np.flatnonzero((at == child) == own)
                radius = np.sqrt(best[active[chosen]].astype(float))[:, None] * (1 + SLACK)
                d = apart[chosen]
                margin = SLACK * (d + radius)
                beyond = (d - radius - margin > node.high[None, :, child]) | (
                    d + radius + margin < node.low[None, :, child]
                )
                chosen = chosen[~beyond.any(1)]
                if len(chosen):
                    self._visit(below, queries, active[chosen], best, index)

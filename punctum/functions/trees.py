"""Balanced KD-trees in numpy: all queries of a block go down the tree together."""

from __future__ import annotations

import numpy as np

LEAF = 16
SLICE = 4096
#: Pairs of a query and a node that are open at once; slices with more are halved.
OPEN = 1 << 18
SLACK = 1 + 1e-12


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = 0.0
    for d in range(a.shape[-1]):
        step = a[..., d] - b[..., d]
        square = square + step * step
    return np.sqrt(square)


def to_boxes(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Distance from positions to boxes; arrays broadcast up to the last axis."""
    square = 0.0
    for d in range(q.shape[-1]):
        gap = np.maximum(np.maximum(low[..., d] - q[..., d], q[..., d] - high[..., d]), 0.0)
        square = square + gap * gap
    return np.sqrt(square)


class Tree:
    """Points with numbers, cut in half along the widest side until leaves hold at most ``LEAF``; unused places are infinite."""

    def __init__(self, points: np.ndarray, numbers: np.ndarray):
        self.depth = 0
        while LEAF << self.depth < len(points):
            self.depth += 1
        room = LEAF << self.depth
        self.points = np.full((room, points.shape[1]), np.inf)
        self.points[: len(points)] = points
        self.numbers = np.full(room, np.iinfo(np.int64).max)
        self.numbers[: len(points)] = numbers
        nodes = np.arange(room)[None]
        for _ in range(self.depth):
            part = self.points[nodes]
            side = np.where(np.isfinite(part), part, -np.inf).max(axis=1) - part.min(axis=1)
            axis = np.argmax(np.where(np.isnan(side), -np.inf, side), axis=1)
            order = np.argsort(np.take_along_axis(part, axis[:, None, None], axis=2)[..., 0], axis=1, kind="stable")
            nodes = np.take_along_axis(nodes, order, axis=1).reshape(len(nodes) * 2, -1)
        leaves = nodes.reshape(-1, LEAF)
        self.points, self.numbers = self.points[leaves], self.numbers[leaves]
        low, high = self.points.min(axis=1), np.where(np.isfinite(self.points), self.points, -np.inf).max(axis=1)
        self.boxes = [(low, high)]
        for _ in range(self.depth):
            low, high = np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2])
            self.boxes.insert(0, (low, high))

    def nearest(self, q: np.ndarray, distance: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distance and number of the nearest point of each position, or what is given if that is nearer; ties to the smaller number."""
        distance, number = distance.copy(), number.copy()
        for at in range(0, len(q), SLICE):
            self._slice(q, distance, number, slice(at, min(at + SLICE, len(q))))
        return distance, number

    def _slice(self, q, distance, number, part: slice) -> None:
        here = q[part]
        node = np.zeros(len(here), np.int64)
        for low, high in self.boxes[1:]:
            left, right = 2 * node, 2 * node + 1
            node = np.where(to_boxes(here, low[right], high[right]) < to_boxes(here, low[left], high[left]), right, left)
        self._improve(here, distance, number, part, np.arange(len(here)), node)
        query, node = np.arange(len(here)), np.zeros(len(here), np.int64)
        for low, high in self.boxes[1:]:
            query, node = np.repeat(query, 2), (2 * node[:, None] + np.arange(2)).ravel()
            near = to_boxes(here[query], low[node], high[node]) <= distance[part][query] * SLACK
            query, node = query[near], node[near]
            if len(query) > OPEN and len(here) > 1:
                middle = (part.start + part.stop) // 2
                self._slice(q, distance, number, slice(part.start, middle))
                return self._slice(q, distance, number, slice(middle, part.stop))
        for at in range(0, len(query), OPEN):
            self._improve(here, distance, number, part, query[at : at + OPEN], node[at : at + OPEN])

    def _improve(self, here, distance, number, part, query, leaf) -> None:
        """Take in the points of leaves; ``query`` rises."""
        if not len(query):
            return
        found = distances(here[query][:, None], self.points[leaf])
        found = np.where(np.isnan(found), np.inf, found)
        least = found.min(axis=1)
        first = np.where(found == least[:, None], self.numbers[leaf], np.iinfo(np.int64).max).min(axis=1)
        starts = np.flatnonzero(np.diff(query, prepend=-1))
        each = query[starts]
        best = np.minimum.reduceat(least, starts)
        first = np.where(least == np.repeat(best, np.diff(starts, append=len(query))), first, np.iinfo(np.int64).max)
        first = np.minimum.reduceat(first, starts)
        d, n = distance[part], number[part]
        better = (best < d[each]) | ((best == d[each]) & (first < n[each]))
        d[each[better]], n[each[better]] = best[better], first[better]

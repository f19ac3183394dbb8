"""Suffix trees of integer sequences with longest common extensions in constant time."""

from __future__ import annotations

import numpy as np


class RangeMin:
    """Smallest value of any range of ``values``, by a table of ranges whose lengths are powers of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        size = 1
        while 2 * size <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-size], last[size:]))
            size *= 2

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The least value from place ``first`` to place ``last``, both included."""
        out = np.empty(len(first), self.levels[0].dtype)
        power = np.frexp(last - first + 1)[1] - 1
        for k in np.unique(power):
            at = np.flatnonzero(power == k)
            out[at] = np.minimum(self.levels[k][first[at]], self.levels[k][last[at] - (1 << int(k)) + 1])
        return out


class SuffixTree:
    """The tree of all suffixes of ``text``, whose last symbol stands nowhere else. Built online in linear time."""

    def __init__(self, text: list[int]) -> None:
        self.text = text
        self.size = len(text)
        self._build()
        self._tour()

    def _build(self) -> None:
        """Suffix links and one active point: every symbol adds the leaves that are not yet implied."""
        text, n = self.text, self.size
        width = max(text) + 1
        children: dict[int, int] = {}  # node * width + first symbol of the edge -> node
        start, end, link, suffix = [0], [0], [0], [-1]
        node = edge = length = waiting = leaves = 0
        for i, symbol in enumerate(text):
            waiting += 1
            fresh = 0
            while waiting:
                if not length:
                    edge = i
                key = node * width + text[edge]
                below = children.get(key)
                if below is None:
                    children[key] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    suffix.append(leaves)
                    leaves += 1
                    if fresh:
                        link[fresh] = node
                        fresh = 0
                else:
                    first = start[below]
                    span = end[below] - first
                    if length >= span and end[below] <= i:
                        node = below
                        edge += span
                        length -= span
                        continue
                    if text[first + length] == symbol:
                        if fresh:
                            link[fresh] = node
                        length += 1
                        break
                    middle = len(start)
                    children[key] = middle
                    children[middle * width + symbol] = middle + 1
                    children[middle * width + text[first + length]] = below
                    start += (first, i)
                    end += (first + length, n)
                    link += (0, 0)
                    suffix += (-1, leaves)
                    leaves += 1
                    start[below] = first + length
                    if fresh:
                        link[fresh] = middle
                    fresh = middle
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        self.width = width
        self.suffix = suffix
        self.span = [b - a for a, b in zip(start, end)]
        keys = np.fromiter(children.keys(), np.int64, len(children))
        self.parents, self.symbols = np.divmod(keys, width)
        self.below = np.fromiter(children.values(), np.int64, len(children))

    def _sorted_children(self, order: np.ndarray) -> tuple[list[int], list[int]]:
        """The children of all nodes, those of one node in falling ``order`` of their edges, and each node's first place."""
        ranked = np.lexsort((-order[self.symbols], self.parents))
        return self.below[ranked].tolist(), np.searchsorted(self.parents[ranked], np.arange(len(self.span) + 1)).tolist()

    def _tour(self) -> None:
        """Euler tour of string depths, the place of every suffix in it, and the ranks of the suffixes."""
        below, bounds = self._sorted_children(np.arange(self.width))
        suffix, span = self.suffix, self.span
        depth = [0] * len(span)
        tour: list[int] = []
        place = np.zeros(self.size, np.int64)
        leaves: list[int] = []
        places: list[int] = []
        stack = [0]
        while stack:
            node = stack.pop()
            if node < 0:
                tour.append(depth[~node])
                continue
            here = depth[node]
            if suffix[node] >= 0:
                leaves.append(suffix[node])
                places.append(len(tour))
                tour.append(here)
                continue
            tour.append(here)
            for child in below[bounds[node] : bounds[node + 1]]:
                depth[child] = here + span[child]
                stack += (~node, child)
        place[leaves] = places
        self.place = place
        self.least = RangeMin(np.array(tour, np.int32))
        self.rank = np.empty(self.size, np.int64)
        self.rank[leaves] = np.arange(self.size)

    def ranks(self, order: np.ndarray) -> np.ndarray:
        """The rank of every suffix where symbols are compared by ``order``."""
        below, bounds = self._sorted_children(order)
        suffix = self.suffix
        leaves: list[int] = []
        stack = [0]
        while stack:
            node = stack.pop()
            if suffix[node] >= 0:
                leaves.append(suffix[node])
            else:
                stack += below[bounds[node] : bounds[node + 1]]
        out = np.empty(self.size, np.int64)
        out[leaves] = np.arange(self.size)
        return out

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Symbols that the suffixes at ``i`` and ``j``, which differ, have in common: the depth of their lowest common ancestor."""
        a, b = self.place[i], self.place[j]
        return self.least.of(np.minimum(a, b), np.maximum(a, b)).astype(np.int64)

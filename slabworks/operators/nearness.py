"""Exact nearest neighbours in the plane by grid cells, for use within one slice."""

from __future__ import annotations

import numpy as np

#: Rings of cells beyond which the few queries that are left are compared with all points.
RINGS = 1_024
#: Distances held at once, unless one query alone has more points to be compared with.
BLOCK = 1_000_000


class Grid:
    """Points in cells of a few points each, sorted by cell."""

    def __init__(self, points: np.ndarray, per_cell: float = 2.0):
        self.points = np.asarray(points, dtype=float)
        low, high = np.quantile(self.points, [0.02, 0.98], axis=0)
        span = np.ptp(self.points, axis=0)
        inner = np.maximum(high - low, span / 2**20)
        size = np.sqrt(max(inner[0] * inner[1], 0.0) * per_cell / len(self.points)) or inner.max() * per_cell / len(self.points)
        self.size = max(size, span.max() / 2**28, 1e-300)
        self.low = self.points.min(axis=0)
        cell = np.floor((self.points - self.low) / self.size).astype(np.int64)
        self.shape = cell.max(axis=0) + 1
        key = cell[:, 0] * self.shape[1] + cell[:, 1]
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]

    def nearest(self, queries: np.ndarray, k: int = 1, own: bool | np.ndarray = False) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances of the k nearest points to each query, ties by place; ``own``: queries are the points, or those at these places, and don't count themselves.

        There must be at least k points to choose from.
        """
        queries = np.asarray(queries, dtype=float)
        at, far = np.full((len(queries), k), -1), np.full((len(queries), k), np.inf)
        left, ring = np.arange(len(queries)), 1
        while len(left):
            todo, step = [], max(1, BLOCK // ((2 * ring + 1) * 16))
            for i in range(0, len(left), step):
                part = left[i : i + step]
                done = self._search(queries, part, k, own, ring, at, far)
                todo.append(part[~done])
            left, ring = np.concatenate(todo), ring * 2
        return at, far

    def _search(self, queries: np.ndarray, part: np.ndarray, k: int, own: bool | np.ndarray, ring: int, at: np.ndarray, far: np.ndarray) -> np.ndarray:
        q = queries[part]
        cell = np.floor((q - self.low) / self.size)
        whole = ring > RINGS
        if whole:
            lo, hi = np.zeros((len(part), 1), np.int64), np.full((len(part), 1), len(self.keys))
        else:
            rows = cell[:, 0][:, None] + np.arange(-ring, ring + 1)
            inside = (rows >= 0) & (rows < self.shape[0])
            base = np.where(inside, rows, 0).astype(np.int64) * self.shape[1]
            first, last = np.clip(cell[:, 1] - ring, 0, self.shape[1]).astype(np.int64), np.clip(cell[:, 1] + ring, -1, self.shape[1] - 1).astype(np.int64)
            lo = np.searchsorted(self.keys, (base + first[:, None]).ravel(), "left").reshape(base.shape)
            hi = np.searchsorted(self.keys, (base + last[:, None]).ravel(), "right").reshape(base.shape)
            hi = np.where(inside, np.maximum(hi, lo), lo)
        n = (hi - lo).ravel()
        if len(part) > 1 and n.sum() > BLOCK:  # crowded cells
            half = len(part) // 2
            return np.concatenate([self._search(queries, p, k, own, ring, at, far) for p in (part[:half], part[half:])])
        of = np.repeat(np.repeat(np.arange(len(part)), lo.shape[1]), n)
        who = self.order[np.repeat(lo.ravel() - np.cumsum(n) + n, n) + np.arange(n.sum())]
        if own is not False:
            other = who != (part if own is True else own[part])[of]
            of, who = of[other], who[other]
        d = ((q[of] - self.points[who]) ** 2).sum(axis=1)
        if k == 1 and len(of):  # rows come by query already: the least of each, then the first of those at that distance
            first = np.flatnonzero(np.diff(of, prepend=-1))
            least = np.minimum.reduceat(d, first)
            ties = d == np.repeat(least, np.diff(first, append=len(of)))
            who = np.where(ties, who, len(self.points))
            at[part[of[first]], 0], far[part[of[first]], 0] = np.minimum.reduceat(who, first), np.sqrt(least)
            return self._settled(q, cell, ring, far[part, 0]) if not whole else np.ones(len(part), bool)
        best = np.lexsort((who, d, of))
        of, who, d = of[best], who[best], d[best]
        start = np.searchsorted(of, np.arange(len(part)))
        nth = np.arange(len(of)) - start[of]
        keep = nth < k
        far[part] = np.inf
        at[part[of[keep]], nth[keep]] = who[keep]
        far[part[of[keep]], nth[keep]] = np.sqrt(d[keep])
        if whole:
            return np.ones(len(part), bool)
        return self._settled(q, cell, ring, far[part, k - 1])

    def _settled(self, q: np.ndarray, cell: np.ndarray, ring: int, farthest: np.ndarray) -> np.ndarray:
        """Whether nothing outside the block of cells can be nearer: nothing there is nearer than its edge."""
        edge = np.minimum(q - (self.low + (cell - ring) * self.size), self.low + (cell + ring + 1) * self.size - q).min(axis=1)
        return farthest < edge


def symmetric_median(a: np.ndarray, b: np.ndarray) -> float:
    """Mean of both directions' median distances to the nearest point of the other set."""
    return float(np.median(Grid(b).nearest(a)[1]) + np.median(Grid(a).nearest(b)[1])) / 2

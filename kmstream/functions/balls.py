"""An index over many centres: balls around pivots, searched exactly.

Centres are split in halves along their widest coordinate until a part has ``leaf`` of
them (about twice the root of their number); a part is a ball, its mean the pivot and its farthest member the radius. By the
triangle inequality no member of a ball is nearer to a row than the row's distance to
the pivot less the radius. A row searches its nearest ball first and then those balls
that could still hold a nearer centre; distances are summed left to right as in the
plain search and ties go to the lowest id, so the results are the same.

The index is built once per model, from centres that travel to the tasks anyway.
"""

from __future__ import annotations

import numpy as np

from kmstream.functions.vectors import _squared, nearest_two

#: Centres from which the index pays, the least size of a ball, and rows searched together.
MANY, LEAST, STEP = 1024, 128, 16_384


def _split(C: np.ndarray, ids: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Parts of at most ``leaf`` ids, ids ascending in each; equal centres may fall in different parts."""
    todo, out = [ids], []
    while todo:
        part = todo.pop()
        if len(part) <= leaf:
            out.append(np.sort(part))
            continue
        axis = int(np.ptp(C[part], axis=0).argmax())
        order = part[np.argsort(C[part, axis], kind="stable")]
        todo += [order[:len(order) // 2], order[len(order) // 2:]]
    return out


class CenterIndex:
    def __init__(self, C: np.ndarray, leaf: int | None = None):
        self.C = np.asarray(C, np.float64)
        self.parts = _split(self.C, np.arange(len(self.C)), leaf or max(LEAST, int(2 * len(self.C) ** 0.5)))
        self.members = [self.C[p] for p in self.parts]
        self.pivots = np.array([m.mean(axis=0) for m in self.members])
        self.radius = np.array([np.sqrt(((m - p) ** 2).sum(axis=1).max()) for m, p in zip(self.members, self.pivots)]) * (1 + 1e-12)

    def nearest_two(self, X: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As :func:`vectors.nearest_two`: (cluster, squared distance, lower bound of the squared distance to any other)."""
        n = len(X)
        cluster, best, other = np.full(n, -1, np.int64), np.full(n, np.nan), np.full(n, np.nan)
        whole = np.flatnonzero(~np.isnan(X).any(axis=1))
        for at in range(0, len(whole), STEP):
            rows = whole[at:at + STEP]
            cluster[rows], best[rows], other[rows] = self._search(X[rows])
        return cluster, best, other

    def _search(self, X: np.ndarray):
        n, balls = len(X), len(self.parts)
        p2 = (self.pivots * self.pivots).sum(axis=1)
        x2 = (X * X).sum(axis=1)
        apart = np.maximum(x2[:, None] - 2.0 * X @ self.pivots.T + p2[None], 0.0)
        slack = 1e-6 * np.sqrt(x2 + p2.max())                       # rounding of the product, well below any radius that matters
        floor = np.maximum(np.sqrt(apart) - slack[:, None] - self.radius[None], 0.0)
        home = apart.argmin(axis=1)
        best, cluster, second = np.full(n, np.inf), np.full(n, -1, np.int64), np.full(n, np.inf)

        def visit(b, rows):
            j, d2, next_ = nearest_two(X[rows], self.members[b])
            ids = self.parts[b][j]
            wins = (d2 < best[rows]) | ((d2 == best[rows]) & (ids < cluster[rows]))
            loser = np.where(wins, best[rows], d2)
            second[rows] = np.minimum(second[rows], np.minimum(loser, next_))
            best[rows] = np.where(wins, d2, best[rows])
            cluster[rows] = np.where(wins, ids, cluster[rows])

        for b in np.unique(home):
            visit(b, np.flatnonzero(home == b))
        seen = np.zeros((n, balls), bool)
        seen[np.arange(n), home] = True
        # a first guess at the second nearest keeps the bound tight: balls that may hold it are searched, too
        for b in range(balls):
            reach = np.sqrt(best) * (1 + 1e-9)
            rows = np.flatnonzero(~seen[:, b] & (floor[:, b] <= reach))
            if len(rows):
                visit(b, rows)
                seen[rows, b] = True
        unseen = np.where(seen, np.inf, floor)
        return cluster, best, np.minimum(second, unseen.min(axis=1, initial=np.inf) ** 2)


def searcher(C: np.ndarray):
    """The search for these centres: plain for few, indexed for many."""
    C = np.asarray(C, np.float64)
    if len(C) >= MANY:
        return CenterIndex(C).nearest_two
    return lambda X: nearest_two(X, C)

"""Rows of a block in nested boxes, and a search that assigns whole boxes to a centre.

The filtering algorithm of Kanungo et al. ("An Efficient k-Means Clustering Algorithm",
PAMI 2002): rows are ordered by halving along the widest coordinate, so that every run of
``LEAF`` x 2^i rows is a box. A centre is dropped from a box when another one is nearer
to all its corners; a box with one centre left adds its sums as they are, and only the rows
of the smallest boxes are compared with the centres that remain, coordinates left to right
and ties to the lowest id. The results are those of the plain search over all centres.

Columns that do not vary inside a box set add one number per centre, and only the others
are compared: wide rows come sorted by their few-valued columns (``operators.blocks``),
and :func:`cut` makes one box set of every run that is equal in them.

Narrow rows that lie on lines are searched along them (``functions.lines``).

Centres of many models are searched together, as one list with the place of each
model's first centre. Rows that vary in ``WIDE`` and more columns go through the plain search.
"""

from __future__ import annotations

import numpy as np

from kmstream.functions.lines import Lines, on_lines
from kmstream.functions.tiles import TILE, nearest_in_tiles
from kmstream.functions.vectors import nearest_centers, nearest_each

#: Columns from which matrix products are faster than boxes: a box in so many dimensions keeps most centres.
WIDE = 9
#: Columns and centres a model, on average, from which sums are faster in tiles (``functions.tiles``).
TILED, MANY = 5, 64
#: Rows of the smallest box and boxes that a box is divided into.
LEAF, FAN = 8, 4
#: Least number of rows, on average, of the runs that a block is cut into.
RUN = 32
#: Centres and models searched together, and rows x centres compared at a time.
CENTERS, MODELS, STEP = 16_384, 256, 1 << 15
#: Pairs of a box and a centre that are tested at a time.
PAIRS = 1 << 14


def box_order(X: np.ndarray) -> np.ndarray:
    """The order of the rows in which runs of LEAF x 2^i rows are boxes."""
    cap = LEAF
    while cap < len(X):
        cap *= 2
    todo, out = [(np.arange(len(X)), cap)], []
    while todo:
        part, cap = todo.pop()
        if len(part) <= LEAF:
            out.append(part)
            continue
        half = cap // 2
        if len(part) <= half:
            todo.append((part, half))
            continue
        S = X[part]
        axis = int((S.max(axis=0) - S.min(axis=0)).argmax())
        order = np.argpartition(S[:, axis], half)
        todo += [(part[order[half:]], half), (part[order[:half]], half)]
    return np.concatenate(out)


def chunks(first: np.ndarray, together: tuple[int, int] = (CENTERS, MODELS)):
    """Runs (from, to) of models that are searched together; ``first`` ends with the number of centres."""
    a, models = 0, len(first) - 1
    while a < models:
        b = min(int(np.searchsorted(first, first[a] + together[0], side="right")) - 1, a + together[1], models)
        b = max(b, a + 1)
        yield a, b
        a = b


def cut(X: np.ndarray, w: np.ndarray) -> list["Boxes"] | list[Lines]:
    """The rows of a block as lines or one box set, or for wide rows one for every run equal in the columns that seldom change."""
    if X.shape[1] < WIDE:
        lines = on_lines(X)
        return [Lines(X, w, *lines) if lines else Boxes(X, w)]
    changed = X[1:] != X[:-1]
    seldom = changed.sum(axis=0) <= len(X) // RUN
    ends = np.flatnonzero(changed[:, seldom].any(axis=1)) + 1
    if len(ends) > len(X) // RUN:
        ends = ends[:0]
    ends = [0, *ends.tolist(), len(X)]
    return [Boxes(X[a:b], w[a:b]) for a, b in zip(ends, ends[1:])]


def _by_leaf(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.reshape(-1, LEAF).T)


class Boxes:
    """``X`` in the order of :func:`box_order`, with weights."""

    #: Centres and models searched together.
    together = (CENTERS, MODELS)

    def __init__(self, X: np.ndarray, w: np.ndarray):
        n, d = X.shape
        cap = LEAF
        while cap < n:
            cap *= 2
        sizes = [cap]
        while sizes[-1] > LEAF:
            sizes.append(max(LEAF, sizes[-1] // FAN))
        self.n, self.d, self.cap = n, d, cap
        varies = X.max(axis=0) > X.min(axis=0)
        self.vary, self.rest = np.flatnonzero(varies), np.flatnonzero(~varies)
        self.same = X[0, self.rest]
        self.rows = np.zeros((cap, d))
        self.rows[:n] = X
        self.x = [np.ascontiguousarray(self.rows[:, i]) for i in self.vary]
        self.w = np.zeros(cap)
        self.w[:n] = w
        self.levels = []
        X = X[:, self.vary]
        sums = np.column_stack([w, w[:, None] * X])
        # by leaf, one line per place in the leaf: the loops run along the leaves
        self.leaf_x = [_by_leaf(x) for x in self.x]
        self.sums = [_by_leaf(v) for v in (self.w, *[self.w * x for x in self.x])]
        still = (self.same * self.same).sum()
        for size in sizes:
            at = np.arange(0, n, size)
            low, high = np.minimum.reduceat(X, at, axis=0), np.maximum.reduceat(X, at, axis=0)
            mid, half = (low + high) / 2, (high - low) / 2
            self.levels.append((size, np.ascontiguousarray(mid.T), np.ascontiguousarray(half.T), np.sqrt((half * half).sum(axis=1)),
                                still + (mid * mid).sum(axis=1) + (half * half).sum(axis=1), np.ascontiguousarray(np.add.reduceat(sums, at, axis=0).T)))

    def _base(self, C: np.ndarray) -> np.ndarray:
        """Every centre's squared distance in the columns that do not vary; equal centres get equal numbers."""
        if len(self.rest) >= WIDE:
            gap = C[:, self.rest] - self.same
            return np.einsum("ij,ij->i", gap, gap)
        out = np.zeros(len(C))
        for i, v in zip(self.rest, self.same):
            gap = C[:, i] - v
            out += gap * gap
        return out

    def _in_reach(self, C: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The centres that can be nearest to a row, by a matrix product and the distance to the middle of all rows."""
        middle = self.rows[0].copy()
        middle[self.vary] = self.levels[0][1][:, 0]
        c2, m2 = np.einsum("ij,ij->i", C, C), float(middle @ middle)
        rough = c2 - 2.0 * (C @ middle) + m2
        slack = 1e-9 * (c2.max() + m2)
        reach = np.sqrt(np.maximum(np.fmin.reduceat(rough, start), 0.0) + slack) + 2 * self.levels[0][3][0]
        return np.flatnonzero(~(rough > np.repeat(reach * reach * (1 + 1e-9) + slack, count)))

    def _kept(self, level: int, C: list, base, node: np.ndarray, cen: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Places of the pairs whose centre can be nearest to a row of its box; one list of centres per box and model."""
        ends, out, a = start + count, [], 0
        while a < len(start):
            # some lists at a time: their numbers stay in the cache
            b = max(a + 1, int(np.searchsorted(ends, start[a] + PAIRS, side="right")))
            at = int(start[a])
            kept = self._near(level, C, base, node[a:b], cen[at:int(ends[b - 1])], start[a:b] - at, count[a:b])
            kept += at
            out.append(kept)
            a = b
        return out[0] if len(out) == 1 else np.concatenate(out)

    def _near(self, level, C, base, node, cen, start, count):
        _, mid, half, radius, norm, _ = self.levels[level]
        one = np.repeat(node, count)
        dist = np.zeros(len(cen)) if base is None else base.take(cen)
        for c, middle in zip(C, mid):
            gap = c.take(cen)
            gap -= middle.take(one)
            gap *= gap
            dist += gap
        best = np.fmin.reduceat(dist, start)
        list_ = np.repeat(np.arange(len(start)), count)
        near = np.flatnonzero(dist <= best.take(list_))
        home = start.copy()
        home[list_.take(near[::-1])] = near[::-1]     # the first of the nearest to the middle
        reach = np.sqrt(best) + 2 * radius.take(node)
        maybe = np.flatnonzero(~(dist > (reach * reach * (1 + 1e-9) + 1e-12 * norm.take(node)).take(list_)))
        own, box = home.take(list_.take(maybe)), one.take(maybe)
        some, mine = cen.take(maybe), cen.take(own)
        across, apart = np.zeros(len(maybe)), np.zeros(len(maybe))
        for c, side in zip(C, half):
            gap = c.take(some)
            gap -= c.take(mine)
            np.abs(gap, out=gap)
            apart += gap
            gap *= side.take(box)
            across += gap
        here, there = dist.take(maybe), dist.take(own)
        slack = 1e-12 * (here + there + norm.take(box))
        drop = (here - there > 2 * across + slack) | ((apart == 0) & (here == there) & (maybe != own))
        return maybe[~drop]

    def pieces(self, C: np.ndarray, first: np.ndarray):
        """("box", level, boxes, centres) of boxes with one centre, then ("rows", leaves, centres, squared distances) by row."""
        if len(self.vary) >= WIDE:
            X = self.rows[:self.n]
            leaves = np.arange(-(-self.n // LEAF))
            for a, b in zip(first, first[1:]):
                who, best = np.full(len(leaves) * LEAF, a), np.zeros(len(leaves) * LEAF)
                near, best[:self.n] = nearest_centers(X, C[a:b])
                who[:self.n] += near
                yield "rows", leaves, who.reshape(-1, LEAF), best.reshape(-1, LEAF)
            return
        start, count = np.asarray(first[:-1], np.int64), np.diff(first)
        cen = self._in_reach(C, start, count) if len(self.rest) >= WIDE else np.arange(int(first[-1]))
        if len(cen) < len(C):
            count = np.bincount(np.searchsorted(first, cen, side="right") - 1, minlength=len(start))
            start = np.cumsum(count) - count
        base = None
        if len(self.rest):
            base = np.full(len(C), np.nan)
            base[cen] = self._base(C[cen])
        C = [np.ascontiguousarray(C[:, i]) for i in self.vary]
        node = np.zeros(len(start), np.int64)
        for level, (size, *_) in enumerate(self.levels):
            keep = self._kept(level, C, base, node, cen, start, count)
            list_ = np.repeat(np.arange(len(start)), count)[keep]
            cen, count = cen[keep], np.bincount(list_, minlength=len(start))
            start = np.cumsum(count) - count
            alone = count == 1
            if alone.any():
                yield "box", level, node[alone], cen[start[alone]]
            node, start, count = node[~alone], start[~alone], count[~alone]
            if not len(node):
                return
            if size > LEAF:
                below, fan = self.levels[level + 1][0], size // self.levels[level + 1][0]
                there = -(-self.n // below)
                children = np.minimum(there - node * fan, fan)
                child = np.repeat(node * fan, children) + np.arange(children.sum()) - np.repeat(np.cumsum(children) - children, children)
                start, count = np.repeat(start, children), np.repeat(count, children)
                fresh = np.cumsum(count) - count
                cen = cen[np.arange(count.sum()) - np.repeat(fresh - start, count)]
                node, start = child, fresh
        order = np.argsort(-count, kind="stable")
        node, start, count = node[order], start[order], count[order]
        step = max(1, STEP // LEAF)
        for at in range(0, len(node), step):
            yield "rows", *self._compared(C, base, cen, node[at:at + step], start[at:at + step], count[at:at + step])

    def _compared(self, C, base, cen, node, start, count):
        X = [x.take(node, axis=1) for x in self.leaf_x]
        best, who = np.empty((LEAF, len(node))), np.empty((LEAF, len(node)), np.int64)
        fewer = -count
        for j in range(int(count[0])):
            m = int(np.searchsorted(fewer, -j, side="left"))      # lists of more than j centres
            c = cen.take(start[:m] + j)
            d2 = np.zeros((LEAF, m))
            if base is not None:
                d2 += base.take(c)
            for x, value in zip(X, C):
                gap = x[:, :m] - value.take(c)
                gap *= gap
                d2 += gap
            if j == 0:
                best[:], who[:] = d2, c
            else:
                wins = d2 < best[:, :m]
                np.copyto(best[:, :m], d2, where=wins)
                np.copyto(who[:, :m], c, where=wins)
        return node, who.T, best.T

    def assigned_sums(self, C: np.ndarray, first: np.ndarray, columns: int | None = None) -> tuple[np.ndarray, int]:
        """((weight, sums) per centre, rows compared with more than one centre); the first ``columns`` of them."""
        total = np.zeros((len(C), self.d + 1 if columns is None else columns))
        return total, self.add_sums(C, first, total)

    def add_sums(self, C: np.ndarray, first: np.ndarray, total: np.ndarray, held: dict | None = None) -> int:
        """Adds (weight, sums) per centre to ``total``, all columns or the weight alone; rows compared with more than one centre."""
        if len(self.vary) >= WIDE:
            self._add_wide(C, first, total)
            return self.n * (len(first) - 1)
        if len(self.vary) == self.d >= TILED and first[-1] >= MANY * (len(first) - 1):
            self._add_tiled(C, first, total)
            return self.n * (len(first) - 1)
        kept, searched = len(self.sums) if total.shape[1] > 1 else 1, 0
        found = np.zeros((kept, len(C)))
        for kind, *piece in self.pieces(C, first):
            if kind == "box":
                level, node, who = piece
                values = [self.levels[level][-1][c, node] for c in range(kept)]
            else:
                node, who, _ = piece
                who = who.T.ravel()
                searched += int(np.minimum(self.n - node * LEAF, LEAF).sum())
                values = [self.sums[c].take(node, axis=1).ravel() for c in range(kept)]
            if len(who):
                low, high = int(who.min()), int(who.max()) + 1
                for c, v in enumerate(values):
                    found[c, low:high] += np.bincount(who - low, weights=v, minlength=high - low)
        used = np.flatnonzero(found[0])
        total[used, 0] += found[0, used]
        if total.shape[1] > 1:
            for i, v in zip(self.vary, found[1:]):
                total[used, 1 + i] += v[used]
            if len(self.rest):
                total[np.ix_(used, 1 + self.rest)] += found[0, used][:, None] * self.same
        return searched

    def _add_tiled(self, C: np.ndarray, first: np.ndarray, total: np.ndarray) -> None:
        """:meth:`add_sums` by tiles of rows."""
        w, rows = self.w[:self.n], self.rows[:self.n]
        values = [w, *[np.ascontiguousarray(w * x) for x in rows.T]][:total.shape[1]]
        for at, model, who in nearest_in_tiles(rows, C, first):
            low, high = int(first[model]), int(first[model + len(who)])
            place = (who - low).ravel()
            for c, v in enumerate(values):
                part = np.broadcast_to(v[at:at + TILE], who.shape).ravel()
                total[low:high, c] += np.bincount(place, weights=part, minlength=high - low)

    def _add_wide(self, C: np.ndarray, first: np.ndarray, total: np.ndarray) -> None:
        """:meth:`add_sums` without boxes: every row is compared with all centres."""
        w = self.w[:self.n]
        values = [w, *[np.ascontiguousarray(w * x) for x in self.rows[:self.n].T]] if total.shape[1] > 1 else [w]
        for m, near in nearest_each(self.rows[:self.n], C, first):
            for c, v in enumerate(values):
                total[first[m]:first[m + 1], c] += np.bincount(near, weights=v, minlength=int(first[m + 1] - first[m]))

    def costs(self, C: np.ndarray, first: np.ndarray, held: dict | None = None) -> np.ndarray:
        """The cost of every model."""
        total = np.zeros(len(first) - 1)
        for rows, cen, d2 in self.scored(C, first):
            total += np.bincount(np.searchsorted(first, cen[:, 0], side="right") - 1, weights=(self.w[rows] * d2).sum(axis=1), minlength=len(total))
        return total

    def drawn(self, C: np.ndarray, first: np.ndarray, chance: np.ndarray, phi: np.ndarray, salts: np.ndarray, hashes: np.ndarray, mix, held: dict | None = None):
        """(models, rows) whose number in (0, 1) lies below chance x weight x squared distance / phi."""
        models, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        hashes = np.append(hashes, np.zeros(self.cap - self.n, np.uint64))
        for rows, cen, d2 in self.scored(C, first):
            # the box's model is that of its first centre
            at = np.searchsorted(first, cen[:, 0], side="right") - 1
            p = chance[at][:, None] * self.w[rows] * d2 / phi[at][:, None]
            u = ((mix(hashes[rows] ^ salts[at][:, None]) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
            i, j = np.nonzero(u < p)
            models.append(at[i])
            found.append(rows[i, j])
        return np.concatenate(models), np.concatenate(found)

    def scored(self, C: np.ndarray, first: np.ndarray, held: dict | None = None):
        """(rows, centres, squared distances) as matrices of one box a line, over all rows and models; rows from ``n`` on weigh nothing."""
        for kind, *piece in self.pieces(C, first):
            if kind == "rows":
                node, who, d2 = piece
                yield node[:, None] * LEAF + np.arange(LEAF), who, d2
                continue
            level, node, cen = piece
            size = self.levels[level][0]
            step = max(1, STEP // size)
            for at in range(0, len(node), step):
                some, c = node[at:at + step], cen[at:at + step]
                d2 = np.broadcast_to(self._base(C[c])[:, None], (len(some), size))
                for i, x in zip(self.vary, self.x):
                    gap = x.reshape(-1, size)[some] - C[c, i][:, None]
                    d2 = d2 + gap * gap
                yield some[:, None] * size + np.arange(size), np.broadcast_to(c[:, None], d2.shape), d2

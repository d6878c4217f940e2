"""Rows on lines, and a search that cuts every line into one run of rows per centre.

Rows that agree in all columns but one and are sorted by that one lie on a line. Along a line
the squared distances to all centres are parabolas of one shape, so they differ by straight lines
and the nearest centres are the lower envelope of those: each centre on it has one run of rows,
from one crossing to the next. The envelope is found as a convex hull is (quickhull), for all
models at once: the centres at both ends first, then those below the crossing of two neighbours.
Sums and costs of a run are differences of running sums, so a scan does not depend on
the number of rows but on lines and centres.

A centre whose distance in the other columns is above the largest distance on the line
cannot be nearest. The bound is guessed from the line before; a line whose largest distance
turns out to be above it is searched again with that distance.

Rows so near to a crossing that rounding could matter are compared one by one, with coordinates
left to right and ties to the lowest id: the results are those of the plain search over all centres.
"""

from __future__ import annotations

import numpy as np

#: Least number of rows, on average, of the lines of a block.
RUN = 32
#: Pairs of rows and centres compared, or rows and models drawn, at a time.
STEP = 1 << 16
#: Rounding of the crossings, as a share of the largest number that they are made of.
SLACK = 1e-12
#: Rows of a run up to which its cost is added up row by row.
SHORT = 4


def on_lines(X: np.ndarray) -> tuple[int, np.ndarray] | None:
    """(column, borders of the lines) if the rows are lines along one column, ``RUN`` rows each on average."""
    n, d = X.shape
    if n < 2 or d < 2 or not np.isfinite(X).all():
        return None
    changed = X[1:] != X[:-1]
    free = int(changed.sum(axis=0).argmax())
    new = np.delete(changed, free, axis=1).any(axis=1)
    if (new.sum() + 1) * RUN > n or not ((X[1:, free] >= X[:-1, free]) | new).all():
        return None
    return free, np.concatenate([[0], np.flatnonzero(new) + 1, [n]])


class ByLine:
    """Centres of many models, every model's in the order of one column; of equal centres only the first."""

    def __init__(self, C: np.ndarray, first: np.ndarray, free: int):
        d, column = C.shape[1], np.ascontiguousarray(C[:, free])
        others = [i for i in range(d) if i != free]
        order = np.concatenate([column[a:b].argsort() + a for a, b in zip(first, first[1:])])
        model = np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first))
        at = column[order]
        tie = np.append((at[1:] == at[:-1]) & (model[1:] == model[:-1]), False)
        tie[1:] |= tie[:-1]
        some = np.flatnonzero(tie)
        if len(some):
            ids = order[some]
            ids = ids[np.lexsort((ids, *C[ids].T, model[some]))]
            mine = np.searchsorted(first, ids, side="right")
            again = ids[1:][(C[ids[1:]] == C[ids[:-1]]).all(axis=1) & (mine[1:] == mine[:-1])]
            keep = ~np.isin(order, again)
            order, model = order[keep], model[keep]
        self.order, self.model = order.astype(np.int32), model
        self.count = np.bincount(model, minlength=len(first) - 1)
        self.first = np.cumsum(self.count) - self.count
        self.free = column[self.order]
        self.rest = [C[self.order, i] for i in others]
        # a guess at the squared size of a cell
        sides = [s for s in np.ptp(C, axis=0) if s > 0]
        volume = np.exp(np.mean(np.log(sides))) if sides else 0.0
        self.cell = 2.0 * d * (volume * volume) / self.count ** (2.0 / max(1, len(sides)))


class Lines:
    """``X`` with weights, as the lines of :func:`on_lines`."""

    #: Centres and models searched together.
    together = (65_536, 4096)

    def __init__(self, X: np.ndarray, w: np.ndarray, free: int, ends: np.ndarray):
        self.n, self.d = X.shape
        self.rows, self.w, self.free, self.ends = X, w, free, ends
        self.others = [i for i in range(self.d) if i != free]
        x, length = X[:, free], np.diff(ends)
        self.mid = (x[ends[:-1]] + x[ends[1:] - 1]) / 2
        self.y = x - np.repeat(self.mid, length)
        self.value = X[ends[:-1]][:, self.others]
        self.heaviest = np.maximum.reduceat(w, ends[:-1])
        self.sums = [np.concatenate([[0.0], np.cumsum(v)]) for v in (w, w * self.y, w * self.y * self.y)]

    def _runs(self, C: np.ndarray, first: np.ndarray, held: dict | None = None):
        """Per line and some models: (line, models, their largest squared distances, runs, rows).

        ``runs`` are (centre, model, from, to); ``rows`` (row, model, centre) were compared one by one.
        """
        held = {} if held is None else held
        if self.free not in held:
            held[self.free] = ByLine(C, first, self.free)
        by = held[self.free]
        models, guess = np.arange(len(by.count)), by.cell
        for line, values in enumerate(self.value):
            h = np.zeros(len(by.order))
            for column, v in zip(by.rest, values):
                gap = column - v
                gap *= gap
                h += gap
            least = np.minimum.reduceat(h, by.first)
            bound = np.maximum(guess, 4.0 * least)
            largest = np.zeros(len(models))
            todo = None
            while todo is None or len(todo):
                limit = bound if todo is None else np.where(np.isin(models, todo), bound, -1.0)
                cand = np.flatnonzero(h <= limit[by.model])
                found, far, runs, rows = self._envelope(line, C, by, h, cand, bound)
                ok = far <= bound[found]
                largest[found] = far
                if not ok.all():
                    sure = np.zeros(len(models), bool)
                    sure[found[ok]] = True
                    runs = [v[sure[runs[1]]] for v in runs]
                    rows = [v[sure[rows[1]]] for v in rows]
                yield line, found[ok], far[ok], runs, rows
                # the second time with all centres: far holds the rounding of its own search
                bound[found[~ok]] = 1.01 * far[~ok] if todo is None else np.inf
                todo = found[~ok]
            guess = 1.6 * largest

    def _envelope(self, line, C, by, h, cand, bound):
        s, e = int(self.ends[line]), int(self.ends[line + 1])
        y = self.y[s:e]
        c, model = by.free[cand] - self.mid[line], by.model[cand]
        b = h[cand] + c * c
        start = np.flatnonzero(np.concatenate([[True], model[1:] != model[:-1]]))
        count = np.diff(np.append(start, len(cand)))
        found, own = model[start].astype(np.int64), np.repeat(np.arange(len(start)), count)
        low, high = float(y[0]), float(y[-1])
        slack = SLACK * (float(b.max()) + max(low * low, high * high)) + 1e-300
        tight, far, sides = np.zeros(len(start), bool), np.zeros(len(start)), []
        for p in (low, high):
            f = b - (2.0 * p) * c
            least = np.minimum.reduceat(f, start)
            near = np.flatnonzero(f <= (least + slack)[own])
            tight |= np.bincount(own[near], minlength=len(start)) > 1
            side = np.zeros(len(start), np.int64)
            side[own[near]] = near
            sides.append(side)
            far = np.maximum(far, least + p * p)
        a, z = sides
        tight |= a > z
        g = np.flatnonzero(~tight & (a < z))
        a, z, ready = a[g], z[g], []
        # the centres between two neighbours that lie below their crossing, or may
        inner = np.maximum(z - a - 1, 0)
        at = np.cumsum(inner) - inner
        idx = np.arange(int(inner.sum())) + np.repeat(a + 1 - at, inner)
        none = inner == 0
        if none.any():
            p = (b[z[none]] - b[a[none]]) / (2.0 * (c[z[none]] - c[a[none]]))
            ready.append((g[none], a[none], z[none], p, b[a[none]] - 2.0 * p * c[a[none]]))
            g, a, z, inner, at = g[~none], a[~none], z[~none], inner[~none], at[~none]
        while len(g):
            p = (b[z] - b[a]) / (2.0 * (c[z] - c[a]))
            env = b[a] - 2.0 * p * c[a]
            f = c[idx]
            f *= np.repeat(-2.0 * p, inner)
            f += b[idx]
            f -= np.repeat(env, inner)
            keep = np.flatnonzero(f <= slack)
            seg = np.searchsorted(at, keep, side="right") - 1 if len(keep) else keep
            over = np.ones(len(g), bool)
            over[seg] = False
            if not over.all() or len(keep):
                f, idx = f[keep], idx[keep]
                new = np.flatnonzero(np.append(True, seg[1:] != seg[:-1]))
                k, many = seg[new], np.diff(np.append(new, len(seg)))
                least = np.minimum.reduceat(f, new)
                clear = least < -slack
                tight[g[k[~clear]]] = True
                hit = np.flatnonzero(f == np.repeat(least, many))
                j = np.empty(len(k), np.int64)
                j[np.searchsorted(new, hit, side="right") - 1] = idx[hit]
                left = idx < np.repeat(j, many)
                rest = np.flatnonzero((idx != np.repeat(j, many)) & np.repeat(clear, many))
                # every interval becomes two, side by side: their centres keep their order
                below = np.add.reduceat(left, new, dtype=np.int64)[clear]
                sizes = np.column_stack([below, many[clear] - 1 - below]).ravel()
                k, j = k[clear], j[clear]
                ready.append((g[over], a[over], z[over], p[over], env[over]))
                g, a, z = np.repeat(g[k], 2), np.column_stack([a[k], j]).ravel(), np.column_stack([j, z[k]]).ravel()
                idx, inner = idx[rest], sizes
                at = np.cumsum(inner) - inner
                # an interval without centres shares its place with the next one
                none = inner == 0
                if none.any():
                    p0 = (b[z[none]] - b[a[none]]) / (2.0 * (c[z[none]] - c[a[none]]))
                    ready.append((g[none], a[none], z[none], p0, b[a[none]] - 2.0 * p0 * c[a[none]]))
                    g, a, z, inner, at = g[~none], a[~none], z[~none], inner[~none], at[~none]
            else:
                ready.append((g, a, z, p, env))
                break
        g, a, z, p, env = (np.concatenate(v) for v in zip(*ready)) if ready else (np.zeros(0, np.int64),) * 3 + (np.zeros(0),) * 2
        np.maximum.at(far, g, env + p * p)
        far += slack
        return found, far, *self._rows_of(line, C, by, c, model, start, count, cand, slack, tight, sides[0], (g, a, z, p), bound, far)

    def _rows_of(self, line, C, by, c, model, start, count, cand, slack, tight, left, crossings, bound, far):
        """(runs, rows) of the envelopes; models that are ``tight`` are compared row by row."""
        s, e = int(self.ends[line]), int(self.ends[line + 1])
        y = self.y[s:e]
        g, a, z, p = crossings
        good = ~tight[g]
        order = np.flatnonzero(good)[np.argsort(a[good])]
        g, a, z, p = g[order], a[order], z[order], p[order]
        margin = slack / (2.0 * (c[z] - c[a])) + 1e-15 * np.abs(p)
        until, since = np.searchsorted(y, p - margin, side="left"), np.searchsorted(y, p + margin, side="right")
        # the centres on the envelope from left to right: every model's first one and the right one of every crossing
        firsts = np.flatnonzero(~tight)
        who, owner = np.concatenate([left[firsts], z]), np.concatenate([firsts, g])
        begin, end = np.concatenate([np.zeros(len(firsts), np.int64), since]), np.full(len(who), e - s)
        order = np.argsort(who)
        who, owner, begin = who[order], owner[order], begin[order]
        last = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
        end[~last] = until          # crossings come in the same order
        real = end > begin
        runs = [by.order[cand[who[real]]].astype(np.int64), model[start[owner[real]]].astype(np.int64), s + begin[real], s + end[real]]
        # rows at the crossings, each once per model
        wide = np.flatnonzero(since > until)
        size = (since - until)[wide]
        at = np.cumsum(size) - size
        rows = np.repeat(until[wide] - at, size) + np.arange(int(size.sum()))
        keys = np.unique(np.repeat(g[wide], size) * (e - s) + rows)
        # rows of a model must be all there
        seen = np.bincount(owner[real], weights=(end - begin)[real], minlength=len(start)) + np.bincount(keys // (e - s), minlength=len(start))
        lost = np.flatnonzero(~tight & (seen != e - s))
        if len(lost):
            tight[lost] = True
            bad = np.isin(owner[real], lost)
            runs = [v[~bad] for v in runs]
            keys = keys[~np.isin(keys // (e - s), lost)]
        if tight.any():
            keys = np.concatenate([keys, (np.flatnonzero(tight)[:, None] * (e - s) + np.arange(e - s)).ravel()])
        rows = [np.zeros(0, np.int64)] * 3
        if len(keys):
            own, row = keys // (e - s), s + keys % (e - s)
            who = np.empty(len(keys), np.int64)
            for m in np.unique(own):
                mine = np.flatnonzero(own == m)
                ids = np.sort(by.order[cand[start[m]:start[m] + count[m]]])
                near, d2 = self._compared(row[mine], C, ids)
                who[mine] = near
                if tight[m]:
                    far[m] = float(d2.max()) + slack
            rows = [row, model[start[own]].astype(np.int64), who]
        return runs, rows

    def _compared(self, rows: np.ndarray, C: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near, best = np.empty(len(rows), np.int64), np.empty(len(rows))
        step = max(1, STEP // len(ids))
        for at in range(0, len(rows), step):
            X, d2 = self.rows[rows[at:at + step]], 0.0
            for i in range(self.d):
                gap = X[:, i, None] - C[ids, i]
                d2 = d2 + gap * gap
            j = d2.argmin(axis=1)
            near[at:at + step], best[at:at + step] = ids[j], d2[np.arange(len(j)), j]
        return near, best

    def assigned_sums(self, C: np.ndarray, first: np.ndarray, columns: int | None = None) -> tuple[np.ndarray, int]:
        """As ``Boxes.assigned_sums``."""
        total = np.zeros((len(C), self.d + 1 if columns is None else columns))
        return total, self.add_sums(C, first, total)

    def add_sums(self, C: np.ndarray, first: np.ndarray, total: np.ndarray, held: dict | None = None) -> int:
        """Adds (weight, sums) per centre to ``total``, all columns or the weight alone; rows compared one by one."""
        searched = 0
        for line, _, _, (who, _, a, b), (row, _, near) in self._runs(C, first, held):
            weight = self.sums[0][b] - self.sums[0][a]
            total[who, 0] += weight
            if total.shape[1] > 1:
                total[who, 1 + self.free] += self.sums[1][b] - self.sums[1][a] + self.mid[line] * weight
                for i, v in zip(self.others, self.value[line]):
                    total[who, 1 + i] += v * weight
            if len(row):
                searched += len(row)
                w = self.w[row]
                np.add.at(total[:, 0], near, w)
                for i in range(total.shape[1] - 1):
                    np.add.at(total[:, 1 + i], near, w * self.rows[row, i])
        return searched

    def _squared(self, rows: np.ndarray, C: np.ndarray, cen: np.ndarray) -> np.ndarray:
        out = 0.0
        for i in range(self.d):
            gap = self.rows[rows, i] - C[cen, i]
            out = out + gap * gap
        return out

    def costs(self, C: np.ndarray, first: np.ndarray, held: dict | None = None) -> np.ndarray:
        """The cost of every model."""
        total = np.zeros(len(first) - 1)
        for line, _, _, (who, model, a, b), (row, own, near) in self._runs(C, first, held):
            w, s1, s2 = (v[b] - v[a] for v in self.sums)
            c, h = C[who, self.free] - self.mid[line], 0.0
            for i, v in zip(self.others, self.value[line]):
                gap = C[who, i] - v
                h = h + gap * gap
            cost = np.maximum(s2 - 2.0 * c * s1 + c * c * w, 0.0) + w * h
            short = np.flatnonzero(b - a <= SHORT)
            if len(short):
                cost[short] = 0.0
                for j in range(SHORT):
                    there = short[a[short] + j < b[short]]
                    cost[there] += self.w[a[there] + j] * self._squared(a[there] + j, C, who[there])
            total += np.bincount(model, weights=cost, minlength=len(total))
            if len(row):
                total += np.bincount(own, weights=self.w[row] * self._squared(row, C, near), minlength=len(total))
        return total

    def scored(self, C: np.ndarray, first: np.ndarray, held: dict | None = None):
        """(rows, centres, squared distances) over all rows and models."""
        for _, _, _, (who, _, a, b), (row, _, near) in self._runs(C, first, held):
            if len(row):
                yield row, near, self._squared(row, C, near)
            size = b - a
            ends, at = np.cumsum(size), 0
            while at < len(who):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STEP, side="right")))
                many = size[at:to]
                before = np.cumsum(many) - many
                rows = np.arange(int(many.sum())) + np.repeat(a[at:to] - before, many)
                cen = np.repeat(who[at:to], many)
                yield rows, cen, self._squared(rows, C, cen)
                at = to

    def drawn(self, C: np.ndarray, first: np.ndarray, chance: np.ndarray, phi: np.ndarray, salts: np.ndarray, hashes: np.ndarray, mix, held: dict | None = None):
        """(models, rows) whose number in (0, 1) lies below chance x weight x squared distance / phi.

        The number of every row and model is compared with the line's largest chance first."""
        models, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for line, some, far, (who, model, a, b), (row, own, near) in self._runs(C, first, held):
            s, e = int(self.ends[line]), int(self.ends[line + 1])
            most = chance[some] * self.heaviest[line] * far / phi[some] * (1 + 1e-6)
            limit = np.minimum(most * 2.0 ** 53 + 2.0, 2.0 ** 53).astype(np.uint64)
            start, key = np.argsort(model * (self.n + 1) + a), None
            place = (model * (self.n + 1) + a)[start]
            apart = np.argsort(own * (self.n + 1) + row)
            single = (own * (self.n + 1) + row)[apart]
            step = max(1, STEP // (e - s))
            live = np.flatnonzero(most > 0)
            for at in range(0, len(live), step):
                m = live[at:at + step]
                hit = (mix(hashes[s:e] ^ salts[some[m]][:, None]) >> np.uint64(11)) < limit[m][:, None]
                i, j = np.nonzero(hit)
                if not len(i):
                    continue
                mine, rows = some[m[i]], s + j
                key = mine * (self.n + 1) + rows
                cen = who[start[np.searchsorted(place, key, side="right") - 1]] if len(place) else np.zeros(len(key), np.int64)
                if len(single):
                    alone = np.minimum(np.searchsorted(single, key), len(single) - 1)
                    here = single[alone] == key
                    cen[here] = near[apart[alone[here]]]
                p = chance[mine] * self.w[rows] * self._squared(rows, C, cen) / phi[mine]
                u = ((mix(hashes[rows] ^ salts[mine]) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
                take = np.flatnonzero(u < p)
                models.append(mine[take])
                found.append(rows[take])
        return np.concatenate(models), np.concatenate(found)

"""G-1..G-6, G-14: decayed online k-means for micro-batches.

Update rule (the public streaming k-means rule): for each cluster with
weight w, centre c, and batch sum s over m rows,
a = alpha (unit "batches") or alpha ** (rows in the batch) (unit "points");
w' = a*w + m; lambda = m / max(w', 1e-16); c' = (1 - lambda)*c + (lambda/m)*s.
A cluster without rows keeps c and gets w' = a*w. Optionally, when the
smallest weight falls below 1e-8 of the largest, the largest cluster is
split into two (the library behaviour).

Per batch the work is one scan: each task reduces its rows to at most k sums,
so a hot cluster holding a third of the rows costs no more than any other, and
only k x d sums reach the driver. Rows with a null or NaN feature are left out
of the update (and of the count) and predicted as null.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame

from kmstream.functions.vectors import as_cols, to_double, with_assignment
from kmstream.operators.cluster import _flat, _sums


@dataclass
class StreamState:
    centers: list[list[float]]
    weights: list[float]
    step: int = 0                     # number of updates applied so far
    rows_seen: int = 0
    k_sum: int = 0                    # sum of per-batch rule-of-thumb k (G-7)
    extra: dict = field(default_factory=dict)

    def copy(self) -> "StreamState":
        return StreamState([list(c) for c in self.centers], list(self.weights), self.step,
                           self.rows_seen, self.k_sum, dict(self.extra))


def decay_from_half_life(half_life: float) -> float:
    """G-2: alpha = 0.5 ** (1 / h)."""
    if half_life <= 0:
        raise ValueError("half life must be positive")
    return math.exp(math.log(0.5) / half_life)


def random_centers(k: int, dim: int, weight: float = 0.0, seed: int = 42) -> StreamState:
    """G-3: seeded standard-normal centres of the data's dimension (D5)."""
    rng = np.random.default_rng(seed)
    return StreamState(rng.standard_normal((k, dim)).tolist(), [float(weight)] * k)


class OnlineKMeans:
    def __init__(self, k: int, decay_factor: float = 1.0, half_life: float | None = None,
                 time_unit: str = "batches", split_dying: bool = True):
        if time_unit not in ("batches", "points"):
            raise ValueError("time_unit must be 'batches' or 'points'")
        self.k = k
        self.alpha = decay_from_half_life(half_life) if half_life else float(decay_factor)
        if self.alpha < 0:
            raise ValueError("decay factor must be >= 0")
        self.time_unit = time_unit
        self.split_dying = split_dying

    # -- one scan per batch ---------------------------------------------------
    @staticmethod
    def batch_sums(batch: DataFrame, cols, centers: Sequence[Sequence[float]]) -> dict:
        """{cluster: (sum vector, count)} of the batch under the given centres."""
        flat, d, array = _flat(batch, cols)
        rows = _sums(flat, d, array, {0: centers}, {0: 0})
        return {int(r["cluster"]): ([float(r[f"s{i}"]) for i in range(d)], int(r["n"])) for r in rows}

    def apply(self, state: StreamState, sums: dict) -> StreamState:
        """The decayed update on the driver (k x d numbers)."""
        new = state.copy()
        total = sum(m for _, m in sums.values())
        a = self.alpha if self.time_unit == "batches" else self.alpha ** total
        new.weights = [w * a for w in new.weights]
        for j, (s, m) in sums.items():
            if m <= 0:
                continue
            w_new = new.weights[j] + m
            lam = m / max(w_new, 1e-16)
            new.weights[j] = w_new
            new.centers[j] = [(1.0 - lam) * c + (lam / m) * si
                              for c, si in zip(new.centers[j], s)]
        if self.split_dying and len(new.weights) > 1:
            wmax = max(new.weights)
            wmin = min(new.weights)
            if wmin < 1e-8 * wmax:
                big = new.weights.index(wmax)
                small = new.weights.index(wmin)
                w = (wmax + wmin) / 2.0
                new.weights[big] = new.weights[small] = w
                base = list(new.centers[big])
                new.centers[big] = [x + 1e-14 * max(abs(x), 1.0) for x in base]
                new.centers[small] = [x - 1e-14 * max(abs(x), 1.0) for x in base]
        new.step += 1
        new.rows_seen += total
        return new

    def update(self, state: StreamState, batch: DataFrame, cols) -> StreamState:
        """G-4 / G-5: one batch; dimension mismatch raises (no silent skip, D5)."""
        d = len(to_double(as_cols(cols)))
        for c in state.centers:
            if len(c) != d:
                raise ValueError(f"dimension mismatch: centres have {len(c)} entries, rows {d}")
        return self.apply(state, self.batch_sums(batch, cols, state.centers))

    @staticmethod
    def predict(state: StreamState, batch: DataFrame, cols, cluster_col: str = "cluster",
                dist_col: str = "dist") -> DataFrame:
        """G-6: nearest centre of the latest model (map-only)."""
        return with_assignment(batch, to_double(as_cols(cols)), state.centers, cluster_col, dist_col)

"""Vector arithmetic as column expressions and the one nearest-centre search.

A feature vector is a list of double columns or one ``array<double>`` column.
Distances to a single literal point are column arithmetic. The search for the
nearest of k centres runs on Arrow batches in NumPy for every model size:
blocks of rows x centres, coordinates summed left to right, ties to the lowest
centre id. Generated code would embed k x d constants and be compiled anew for
every model.

Rule for incomplete rows: a row with a null or NaN feature has no nearest
centre (cluster and distance are null) and no model is trained on it.
"""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Numbers of one rows x centres block of the search.
BLOCK = 1 << 16   # stays in the second-level cache
#: Centres of the models that :func:`nearest_each` multiplies at once, and numbers of one product.
GROUP, PRODUCT = 1024, 1 << 19


class ArrayVec:
    """A vector held in one ``array<double>`` column of known width."""

    def __init__(self, col: str | Column, dim: int):
        self._col = col            # resolved lazily: no Column before a session exists
        self.dim = int(dim)

    @property
    def col(self) -> Column:
        return F.col(self._col) if isinstance(self._col, str) else self._col

    def __len__(self) -> int:
        return self.dim

    def elements(self) -> list[Column]:
        return [self.col.getItem(i) for i in range(self.dim)]


def as_cols(cols):
    if isinstance(cols, ArrayVec):
        return cols
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def to_double(xs):
    """Cast a vector (column list or ArrayVec) to doubles."""
    if isinstance(xs, ArrayVec):
        return ArrayVec(xs.col.cast("array<double>"), xs.dim)
    return [x.cast("double") for x in as_cols(xs)]


def elements(xs) -> list[Column]:
    return xs.elements() if isinstance(xs, ArrayVec) else list(xs)


def complete(xs) -> Column:
    """True where every feature is a number (neither null nor NaN)."""
    if isinstance(xs, ArrayVec):
        bad = F.exists(xs.col, lambda v: v.isNull() | F.isnan(v))
        return F.coalesce(xs.col.isNotNull() & ~bad, F.lit(False))
    return reduce(lambda p, q: p & q, [x.isNotNull() & ~F.isnan(x) for x in xs])


def _check_dim(xs: Sequence, center: Sequence[float]) -> None:
    if len(xs) != len(center):
        raise ValueError(
            f"dimension mismatch: vector has {len(xs)} entries, centre has {len(center)}")


def sq_distance(xs, center: Sequence[float]) -> Column:
    """Squared Euclidean distance between a vector and a literal point.

    Summation runs left to right over the coordinates in both forms.
    """
    _check_dim(xs, center)
    if isinstance(xs, ArrayVec):
        lit = F.array(*[F.lit(float(c)) for c in center])
        sq = F.zip_with(xs.col, lit, lambda a, b: (a - b) * (a - b))
        return F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v)
    terms = [(x - F.lit(float(c))) * (x - F.lit(float(c))) for x, c in zip(xs, center)]
    return reduce(add, terms)


def distance(xs, center: Sequence[float]) -> Column:
    return F.sqrt(sq_distance(xs, center))


def _squared(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """Squared distances of matching rows (or of rows x centres by broadcasting), coordinates left to right."""
    out = 0.0
    for i in range(X.shape[-1]):
        diff = X[..., i] - C[..., i]
        out = out + diff * diff
    return out


def nearest_centers(X: np.ndarray, C: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) per row of ``X``; incomplete (NaN) rows get -1 and NaN."""
    return nearest_two(X, C)[:2]


def nearest_two(X: np.ndarray, C: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, squared distance, lower bound of the squared distance to any other centre) per row.

    A matrix product finds, for each row, the centres that can be nearest given
    its rounding error; distances summed left to right then decide, ties to the
    lowest id. Nearly always one centre is left.
    """
    n, k = len(X), len(C)
    cluster, best, other = np.full(n, -1, np.int64), np.full(n, np.nan), np.full(n, np.nan)
    c2 = (C * C).sum(axis=1)
    right = np.vstack([-2.0 * C.T, c2])   # [x, 1] @ right = |c|^2 - 2 x.c
    step = max(1, BLOCK // max(1, k))
    for at in range(0, n, step):
        rows = at + np.flatnonzero(~np.isnan(X[at:at + step]).any(axis=1))
        part, each = X[rows], np.arange(len(rows))
        rough = np.column_stack([part, np.ones(len(part))]) @ right
        j = rough.argmin(axis=1)
        low = rough[each, j]
        rough[each, j] = np.inf
        x2 = (part * part).sum(axis=1)
        slack = 1e-12 * (x2 + c2.max(initial=0.0))
        d2 = _squared(part, C[j])
        second = rough.min(axis=1)
        close = np.flatnonzero(~(second > low + slack))   # another centre may be as near
        for r in range(0, len(close) if k > 1 else 0, max(1, step // 8)):
            some = close[r:r + max(1, step // 8)]
            full = _squared(part[some, None, :], C[None, :, :])
            j[some] = full.argmin(axis=1)
            d2[some] = full.min(axis=1)
        cluster[rows], best[rows], other[rows] = j, d2, np.maximum(second + x2 - slack, 0.0)
    return cluster, best, other


def nearest_each(X: np.ndarray, C: np.ndarray, first: np.ndarray):
    """(model, cluster per row) for every model of the list ``C``; ``first`` holds each model's first centre and the list's length.

    The answers of :func:`nearest_centers`. Products in single precision serve many models at once and decide the rows
    whose nearest centre is clear given their rounding error; the others are decided in double precision.
    """
    n, d = X.shape
    middle = X.mean(axis=0) if n else np.zeros(d)
    with np.errstate(all="ignore"):
        near, far = X - middle, C - middle
        x2, c2 = np.einsum("ij,ij->i", near, near), np.einsum("ij,ij->i", far, far)
        left = np.column_stack([near, np.ones(n)]).astype(np.float32)
        right = np.vstack([-2.0 * far.T, c2]).astype(np.float32)
    a, models = 0, len(first) - 1
    while a < models:
        b = min(max(a + 1, int(np.searchsorted(first, first[a] + GROUP, side="right")) - 1), models)
        at, own = int(first[a]), first[a:b + 1] - first[a]
        cluster, unclear = np.empty((b - a, n), np.int64), np.zeros((b - a, n), bool)
        top = [c2[at + p:at + q].max() for p, q in zip(own, own[1:])]
        part = np.ascontiguousarray(right[:, at:int(first[b])])
        step = max(1, PRODUCT // part.shape[1])
        with np.errstate(all="ignore"):
            for r in range(0, n, step):
                rough = left[r:r + step] @ part
                each = np.arange(len(rough))
                error = 4.0 * (d + 8) * 2.0 ** -24
                for m, (p, q) in enumerate(zip(own, own[1:])):
                    mine = rough[:, p:q]
                    j = mine.argmin(axis=1)
                    cluster[m, r:r + step] = j
                    if q - p > 1:
                        low = mine[each, j].astype(np.float64)
                        mine[each, j] = np.inf
                        unclear[m, r:r + step] = ~(mine.min(axis=1) - low > error * (x2[r:r + step] + top[m]) + 1e-36)
        for m, (p, q) in enumerate(zip(own, own[1:])):
            rows = np.flatnonzero(unclear[m])
            if len(rows):
                cluster[m, rows] = _decided(X[rows], C[at + p:at + q])
            yield a + m, cluster[m]
        a = b


def _decided(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """The nearest centre per row, by a product in double precision and, where that is not clear, by :func:`nearest_centers`."""
    with np.errstate(all="ignore"):
        c2 = np.einsum("ij,ij->i", C, C)
        rough = c2 - 2.0 * (X @ C.T)
        each, j = np.arange(len(X)), rough.argmin(axis=1)
        low = rough[each, j]
        rough[each, j] = np.inf
        unclear = np.flatnonzero(~(rough.min(axis=1) - low > 1e-12 * (np.einsum("ij,ij->i", X, X) + c2.max())))
    for r in range(0, len(unclear), 4096):
        some = unclear[r:r + 4096]
        j[some] = nearest_centers(X[some], C)[0]
    return j


def as_matrix(columns: Sequence[pd.Series], d: int, array: bool) -> np.ndarray:
    """Arrow batch columns as an n x d matrix; nulls and arrays of another length become NaN rows."""
    if not array:
        return np.column_stack([c.to_numpy(dtype=np.float64, na_value=np.nan) for c in columns]) if len(columns[0]) else np.zeros((0, d))
    rows = columns[0].to_numpy()
    try:
        return np.stack(rows).astype(np.float64).reshape(len(rows), d)
    except (ValueError, TypeError):
        out = np.full((len(rows), d), np.nan)
        for i, r in enumerate(rows):
            if r is not None and len(r) == d:
                out[i] = np.asarray(r, dtype=np.float64)
        return out


def nearest_any(xs, centers: Sequence[Sequence[float]], d2_name: str = "d2", cluster_name: str = "cluster") -> Column:
    """struct(d2, cluster) of the nearest centre, as an Arrow-batched column."""
    if not len(centers):
        raise ValueError("no centres")
    _check_dim(xs, centers[0])
    C, array = np.asarray(centers, dtype=np.float64), isinstance(xs, ArrayVec)

    from kmstream.functions.balls import MANY, CenterIndex
    search = CenterIndex(C).nearest_two if len(C) >= MANY else lambda X: nearest_two(X, C)

    @F.pandas_udf(f"{d2_name} double, {cluster_name} int")
    def near(*cols: pd.Series) -> pd.DataFrame:
        cluster, d2, _ = search(as_matrix(cols, C.shape[1], array))
        return pd.DataFrame({d2_name: pd.Series(d2).astype("Float64").mask(np.isnan(d2)),
                             cluster_name: pd.Series(cluster).astype("Int32").mask(cluster < 0)})

    # not deterministic for the optimizer: a filter on the distance must not evaluate the search a second time
    return near.asNondeterministic()(*([xs.col] if array else list(xs)))


def with_assignment(df: DataFrame, xs, centers: Sequence[Sequence[float]],
                    cluster_col: str = "cluster", dist_col: str | None = "dist") -> DataFrame:
    """F-4 / F-7: add nearest cluster id and (optionally) distance to it."""
    cols = [F.col(f"`{c}`") for c in df.columns if c not in (cluster_col, dist_col)]
    out = df.select(*cols, nearest_any(xs, centers).alias("_near"))
    extra = [F.sqrt(F.col("_near.d2")).alias(dist_col)] if dist_col else []
    return out.select(*cols, F.col("_near.cluster").alias(cluster_col), *extra)


def with_keyed_assignment(df: DataFrame, key: Column, xs: Sequence[Column], models: dict,
                          cluster_col: str = "cluster", dist_col: str = "dist") -> DataFrame:
    """Nearest centre under the model of each row's key, in one pass.

    ``key`` is a string column; ``models`` maps its values to centres (one
    model per key of a micro-batch). Rows whose key has no model get nulls.
    """
    cols = [F.col(f"`{c}`") for c in df.columns if c not in (cluster_col, dist_col)]
    C = {k: np.asarray(c, dtype=np.float64) for k, c in models.items()}

    @F.pandas_udf("d2 double, cluster int")
    def near(keys: pd.Series, *features: pd.Series) -> pd.DataFrame:
        X = as_matrix(features, len(features), False)
        d2, cluster = np.full(len(X), np.nan), np.full(len(X), -1)
        for k, at in keys.groupby(keys).indices.items():
            if k in C:
                cluster[at], d2[at] = nearest_centers(X[at], C[k])
        return pd.DataFrame({"d2": pd.Series(d2).astype("Float64").mask(np.isnan(d2)),
                             "cluster": pd.Series(cluster).astype("Int32").mask(cluster < 0)})

    out = df.select(*cols, near.asNondeterministic()(key, *xs).alias("_near"))
    return out.select(*cols, F.col("_near.cluster").alias(cluster_col), F.sqrt(F.col("_near.d2")).alias(dist_col))

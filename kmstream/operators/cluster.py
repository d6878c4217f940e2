"""F-1..F-9, F-13..F-15: k-means fitting, assignment and distance scores.

Two fitting paths:

* :func:`lloyd` -- Lloyd iterations from given starts, on plain double columns
  or one ``array<double>`` column. One iteration is one scan for all models
  (an elbow sweep over k, or restarts): every Arrow batch is assigned in NumPy
  and reduced to at most (models x k) partial rows before anything is
  shuffled, so skewed clusters cost nothing extra and only the k x d sums
  reach the driver. The last scan also gives sizes, cost and mean distance.
* :func:`fit_kmeans` -- ``pyspark.ml.clustering.KMeans`` (k-means|| starts)
  with best-of-N restarts judged by training cost (F-3).

Rows with a null or NaN feature are left out of every fit and score; the
result's ``n`` is the number of rows that took part.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kmstream.functions.vectors import ArrayVec, as_cols, as_matrix, complete, nearest_centers, nearest_each, to_double

#: Counts that a task of :func:`label_counts` holds before it adds up equal ones.
COUNTS = 1 << 20


def _flat(data: DataFrame, cols, keep: Sequence[str] = ()) -> tuple[DataFrame, int, bool]:
    """The complete rows as ``keep`` + (_arr) or (_f0, _f1, ...): (frame, width, is array)."""
    xs = to_double(as_cols(cols))
    if isinstance(xs, ArrayVec):
        flat = data.select(*keep, xs.col.alias("_arr"))
        return flat.filter(complete(ArrayVec("_arr", xs.dim))), len(xs), True
    flat = data.select(*keep, *[x.alias(f"_f{i}") for i, x in enumerate(xs)])
    return flat.filter(complete([F.col(f"_f{i}") for i in range(len(xs))])), len(xs), False


def batch_matrix(pdf: pd.DataFrame, d: int, array: bool) -> np.ndarray:
    return as_matrix([pdf["_arr"]] if array else [pdf[f"_f{i}"] for i in range(d)], d, array)


def _sums(flat: DataFrame, d: int, array: bool, models: Mapping, ids: Mapping) -> list:
    """Per (model, cluster): n, sums, cost, sum of distances -- one scan."""
    Cs = [(ids[k], np.asarray(c, dtype=np.float64)) for k, c in models.items()]
    names = ["n", *[f"s{i}" for i in range(d)], "cost", "sdist"]
    schema = "model long, cluster long, n long, " + ", ".join(f"{c} double" for c in names[1:])

    def partial(batches):
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            X = batch_matrix(pdf, d, array)
            for mid, C in Cs:
                k = len(C)
                cl, d2 = nearest_centers(X, C)
                part = np.stack([np.bincount(cl, minlength=k),
                                 *[np.bincount(cl, weights=X[:, i], minlength=k) for i in range(d)],
                                 np.bincount(cl, weights=d2, minlength=k),
                                 np.bincount(cl, weights=np.sqrt(d2), minlength=k)], axis=1)
                total[mid] = total[mid] + part if mid in total else part
        for mid, part in total.items():
            out = pd.DataFrame(part, columns=names)
            out.insert(0, "cluster", np.arange(len(part)))
            out.insert(0, "model", mid)
            yield out[out["n"] > 0].astype({"n": "int64"})

    parts = flat.mapInPandas(partial, schema)
    return parts.groupBy("model", "cluster").agg(*[F.sum(c).alias(c) for c in names]).collect()


@dataclass
class KMeansResult:
    """Centres plus the score of the final centres over the fitted data."""
    centers: list[list[float]]
    iterations: int = 0
    sizes: list[int] = field(default_factory=list)
    cost: float = 0.0          # sum of squared distances to own centre
    sum_dist: float = 0.0      # sum of distances to own centre
    n: int = 0

    @property
    def k(self) -> int:
        return len(self.centers)

    @property
    def mean_distance(self) -> float:
        return self.sum_dist / self.n if self.n else 0.0


# ---------------------------------------------------------------- starts

def first_rows_init(df: DataFrame, cols, order_by: str | Sequence[str],
                    k: int) -> list[list[float]]:
    """Starts = the first k rows by a key (TakeOrdered: k rows per task)."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    flat, d, array = _flat(df, cols, order)
    rows = flat.orderBy(*order).limit(k).collect()
    return [[float(v) for v in (r["_arr"] if array else [r[f"_f{i}"] for i in range(d)])] for r in rows]


def mean_centers(df: DataFrame, cols: Sequence[str]) -> list[list[float]]:
    """k = 1 model: the column means (``pyspark.ml`` needs k > 1)."""
    flat, d, _ = _flat(df, cols)
    row = flat.agg(*[F.avg(f"_f{i}") for i in range(d)]).first()
    return [[float(v) for v in row]] if row[0] is not None else []


# ---------------------------------------------------------------- Lloyd

def lloyd(data: DataFrame, cols: Sequence[str | Column],
          inits: Mapping[object, Sequence[Sequence[float]]],
          max_iter: int = 20, tol: float = 1e-4, score: bool = True,
          persist: bool = True) -> dict[object, KMeansResult]:
    """Fit several k-means models from fixed starts, sharing every scan.

    ``inits`` maps a model key (e.g. k) to its starting centres. A model stops
    when no centre moved by more than ``tol`` (Euclidean), or after
    ``max_iter`` updates. An empty cluster keeps its centre. With ``score``,
    one more shared scan records sizes, cost and mean distance under the
    final centres.
    """
    flat, d, array = _flat(data, cols)
    for key, c in inits.items():
        for row in c:
            if len(row) != d:
                raise ValueError(f"model {key!r}: centre width {len(row)} != data width {d}")
    cached = flat.persist(StorageLevel.MEMORY_AND_DISK) if persist else flat
    ids = {key: i for i, key in enumerate(inits)}
    centers = {key: [list(map(float, r)) for r in c] for key, c in inits.items()}
    iters = {key: 0 for key in inits}
    active = set(inits)
    try:
        for _ in range(max_iter):
            if not active:
                break
            act = {k: centers[k] for k in inits if k in active}
            rows = _sums(cached, d, array, act, ids)
            by_model: dict[int, dict[int, tuple]] = {}
            for r in rows:
                by_model.setdefault(r["model"], {})[r["cluster"]] = (
                    [r[f"s{i}"] for i in range(d)], r["n"])
            for key in list(active):
                sums = by_model.get(ids[key], {})
                new = []
                moved = 0.0
                for j, old in enumerate(centers[key]):
                    if j in sums and sums[j][1] > 0:
                        s, n = sums[j]
                        c = [si / n for si in s]
                    else:
                        c = old
                    moved = max(moved, sum((a - b) ** 2 for a, b in zip(c, old)))
                    new.append(c)
                centers[key] = new
                iters[key] += 1
                if moved <= tol * tol:
                    active.discard(key)
        results = {key: KMeansResult(centers[key], iters[key]) for key in inits}
        if score:
            _score_into(cached, d, array, results, ids)
        return results
    finally:
        if persist:
            cached.unpersist()


def _score_into(flat: DataFrame, d: int, array: bool, results: Mapping[object, KMeansResult], ids: Mapping) -> None:
    by_id = {v: k for k, v in ids.items()}
    for r in results.values():
        r.sizes = [0] * r.k
    for row in _sums(flat, d, array, {k: r.centers for k, r in results.items()}, ids):
        res = results[by_id[row["model"]]]
        res.sizes[row["cluster"]] = int(row["n"])
        res.cost += float(row["cost"])
        res.sum_dist += float(row["sdist"])
        res.n += int(row["n"])


def score_centers(data: DataFrame, cols, models: Mapping[object, Sequence[Sequence[float]]]) -> dict[object, KMeansResult]:
    """Sizes, cost and mean distance of given centres, all models in one scan."""
    flat, d, array = _flat(data, cols)
    results = {k: KMeansResult([list(map(float, r)) for r in c]) for k, c in models.items()}
    _score_into(flat, d, array, results, {key: i for i, key in enumerate(models)})
    return results


# ---------------------------------------------------------------- pyspark.ml

def assemble(df: DataFrame, cols: Sequence[str], output_col: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=output_col,
                           handleInvalid="error").transform(df)


def fit_kmeans(df: DataFrame, k: int, features_col: str = "features", runs: int = 1,
               tol: float = 1e-4, max_iter: int = 20, seed: int = 1,
               init_mode: str = "k-means||") -> KMeansResult:
    """F-1..F-3: library k-means; ``runs`` seeds, lowest training cost wins.

    k = 1 is served by the mean vector (the library requires k > 1).
    The input should be cached by the caller when ``runs`` > 1.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    if k == 1:
        from pyspark.ml.stat import Summarizer
        mean = df.select(Summarizer.mean(F.col(features_col)).alias("m")).first()["m"]
        return KMeansResult([list(map(float, mean.toArray()))], 1)
    best = None
    for r in range(runs):
        model = KMeans(k=k, featuresCol=features_col, predictionCol="_pred", tol=tol,
                       maxIter=max_iter, seed=seed + r, initMode=init_mode).fit(df)
        cost = model.summary.trainingCost
        if best is None or cost < best[0]:
            best = (cost, model)
    model = best[1]
    return KMeansResult([list(map(float, c)) for c in model.clusterCenters()],
                        model.summary.numIter, cost=best[0])


def _added(seen: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers of ``seen`` with the sums of their counts."""
    pairs, at = np.unique(np.concatenate(seen), return_inverse=True)
    return pairs, np.bincount(at, weights=np.concatenate(counts), minlength=len(pairs)).astype(np.int64)


def label_counts(df: DataFrame, cols, models: Mapping[int, Sequence[Sequence[float]]], label_col: str,
                 model_col: str = "k") -> DataFrame:
    """F-12 for many models in one scan: (k, cluster, label, cnt).

    Each task reduces its rows to one count per (model, cluster, label); rows
    are never repeated per model. Incomplete rows are left out.
    """
    flat, d, array = _flat(df, cols, [F.col(label_col).cast("string").alias("_label")])
    if len(models) > 1:
        # many searches a row: dealt over all cores, however few parts the rows lie in
        flat = flat.repartition(df.sparkSession.sparkContext.defaultParallelism)
    keys = np.array([int(k) for k in models], np.int64)
    Cs = [np.asarray(c, np.float64).reshape(-1, d) for c in models.values()]
    first = np.cumsum([0, *map(len, Cs)])
    all_ = np.concatenate([np.zeros((0, d)), *Cs])

    def partial(batches):
        codes: dict = {}
        seen, counts, held = [], [], 0
        for pdf in batches:
            X = batch_matrix(pdf, d, array)
            code, names = pd.factorize(pdf["_label"], use_na_sentinel=False)
            label = np.array([codes.setdefault(None if pd.isna(v) else v, len(codes)) for v in names], np.int64)[code]
            for m, near in nearest_each(X, all_, first):
                # the centre's place in the list of all and the label's code as one number
                pairs, n = np.unique(((first[m] + near) << 32) | label, return_counts=True)
                seen.append(pairs)
                counts.append(n)
                held += len(n)
            if held > 2 * COUNTS:
                seen, counts = ([v] for v in _added(seen, counts))
                held = len(seen[0]) // 2
        if seen:
            pairs, n = _added(seen, counts)
            place, names = pairs >> 32, np.array(list(codes), dtype=object)
            model = np.searchsorted(first, place, side="right") - 1
            yield pd.DataFrame({model_col: keys[model], "cluster": place - first[model], "label": names[pairs & 0xFFFFFFFF], "cnt": n})

    parts = flat.mapInPandas(partial, f"{model_col} long, cluster long, label string, cnt long")
    return parts.groupBy(model_col, "cluster", "label").agg(F.sum("cnt").alias("cnt"))


# ---------------------------------------------------------------- one model per group

def _group_centers_frame(centers: DataFrame, group_col: str) -> DataFrame:
    """(g, cs: array<struct(cluster, v)>) sorted by cluster -- one small row per group."""
    return centers.groupBy(group_col).agg(
        F.array_sort(F.collect_list(F.struct("cluster", "v"))).alias("cs"))


def _nearest_in_group(x: Column, cs: Column) -> Column:
    """struct(d2, cluster) of the nearest centre among the row's own group's centres.

    Coordinates are summed left to right; the (d2, cluster) order gives the
    lowest id on ties. ``cs`` holds at most k entries per row.
    """
    cands = F.transform(cs, lambda c: F.struct(
        F.aggregate(F.zip_with(x, c["v"], lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                    lambda acc, t: acc + t).alias("d2"),
        c["cluster"].alias("cluster")))
    return F.array_min(cands)


def grouped_lloyd(df: DataFrame, group_col: str, id_col: str, cols: Sequence[str], k: int,
                  max_iter: int, tol: float = 0.0) -> DataFrame:
    """Fixed-start Lloyd fitted separately for every group, all groups in each scan.

    Starts: the first k complete rows of each group by ``id_col`` (the window's
    ``row_number() <= k`` filter is pre-limited per task before the shuffle,
    so a group holding a third of all rows ships only k rows). Each update
    is one aggregation over (group, cluster); empty clusters keep their
    centre. Updates end when no centre of any group moved by more than
    ``tol``. The centre table (groups x k rows) is written to the shared folder
    each time, which keeps the lineage flat, and the one before it is deleted.
    Returns ``(group, cluster, v)``.
    """
    from pyspark.sql import Window

    from kmstream.session import drop_stored, stored
    spark = df.sparkSession
    df = df.filter(complete([F.col(c).cast("double") for c in cols]))
    x = F.array(*[F.col(c).cast("double") for c in cols])
    w = Window.partitionBy(group_col).orderBy(id_col)
    centers = (df.select(group_col, id_col, x.alias("v"))
               .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
               .select(group_col, (F.col("_rn") - 1).cast("int").alias("cluster"), "v"))
    centers, place = stored(spark, centers, "group-centers")
    data = df.select(group_col, x.alias("_x"))
    for _ in range(max_iter):
        near = (data.join(_group_centers_frame(centers, group_col), group_col)
                .select(group_col, "_x", _nearest_in_group(F.col("_x"), F.col("cs")).alias("_n")))
        sums = (near.groupBy(group_col, F.col("_n.cluster").alias("cluster"))
                .agg(F.count(F.lit(1)).alias("_m"),
                     *[F.sum(F.col("_x").getItem(i)).alias(f"_s{i}") for i in range(len(cols))]))
        means = sums.select(group_col, "cluster", F.array(*[F.col(f"_s{i}") / F.col("_m")
                                                            for i in range(len(cols))]).alias("_new"))
        moved = F.aggregate(F.zip_with("v", "_v", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, t: acc + t)
        new = (centers.withColumnRenamed("v", "_v").join(means, [group_col, "cluster"], "left")
               .select(group_col, "cluster", F.coalesce("_new", "_v").alias("v"), "_v"))
        new = new.select(group_col, "cluster", "v", moved.alias("_moved"))
        new, now = stored(spark, new, "group-centers")
        drop_stored(spark, place)
        centers, place = new.drop("_moved"), now
        far = new.agg(F.max("_moved")).first()[0]
        if far is None or far <= tol * tol:
            break
    return centers


def grouped_assign(df: DataFrame, group_col: str, cols: Sequence[str], centers: DataFrame,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Each complete row's cluster and distance under its own group's centres."""
    xs = [F.col(c).cast("double") for c in cols]
    joined = df.filter(complete(xs)).select(group_col, *keep, F.array(*xs).alias("_x")).join(
        _group_centers_frame(centers, group_col), group_col)
    near = joined.select(group_col, *keep, _nearest_in_group(F.col("_x"), F.col("cs")).alias("_n"))
    return near.select(group_col, *keep, F.col("_n.cluster").alias("cluster"), F.sqrt("_n.d2").alias("dist"))

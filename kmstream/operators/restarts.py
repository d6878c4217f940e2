"""F-3 / F-14: k-means with random restarts, all runs and all k in shared scans.

Starts follow k-means|| (Bahmani et al., "Scalable K-Means++", VLDB 2012):
one uniformly drawn row, then ``steps`` rounds in which every row joins the
candidate set with probability min(1, l * w * d^2(x, C) / cost(C)), l = 2k, w
its multiplicity; candidates are weighted by the rows closest to them and
reduced to k centres by weighted k-means++ plus a few weighted Lloyd steps.

Draws are hashes of (seed, round, row content), so the starts depend neither on
batch sizes nor on partitions. Candidates, about 4k a model, meet the blocks of rows
(``operators.blocks``) as a broadcast up to ``BROADCAST`` bytes; beyond, they are a table (model, x)
whose groups of models meet the blocks by an equi-join salted by block. Their weights are
summed in Spark, and every model's candidates are reduced in one piece by a task.
The driver holds a pass's candidates up to ``BROADCAST``, one cost per model and the k
centres that were asked for.

The fits then continue with :func:`kmstream.operators.blocks.bounded_lloyd` and the
best run per k is the one with the lowest training cost. A sweep takes several passes
of at most ``blocks.MODELS`` models and sums of ``blocks.NUMBERS`` numbers; starts take
passes of their own, whose candidates fit a broadcast.
"""

from __future__ import annotations

from typing import Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kmstream.functions.boxes import WIDE, Boxes, box_order, chunks, cut
from kmstream.functions.vectors import ArrayVec, nearest_each
from kmstream.operators.blocks import MODELS, NUMBERS, PIECE, ScanCount, added, arrow_rows, bounded_lloyd, fine_parts, matrix, pack, parts_of, tasks
from kmstream.operators.cluster import KMeansResult, _flat
from kmstream.session import drop_stored, stored

#: Centres, numbers of centres of the models that are listed as one row, and bytes up to which all candidates are broadcast.
GROUP, GROUP_NUMBERS, BROADCAST = 8192, 1 << 18, 96 << 20
#: Numbers of rows and models drawn at a time.
DRAWS = 1 << 15
#: Centres from which the candidates of a model are searched in boxes.
BOXED = 1024


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def content_hash(X: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every row's numbers."""
    bits = np.ascontiguousarray(X + 0.0).view(np.uint64)
    h = np.full(len(X), 0x9E3779B97F4A7C15, np.uint64)
    for c in range(X.shape[1]):
        h = _mix(h ^ (bits[:, c] + np.uint64(c + 1)))
    return h


def _salts(seeds: np.ndarray, step: int) -> np.ndarray:
    return _mix(((seeds.astype(np.uint64) & np.uint64(0xFFFFFFFF)) << np.uint64(20)) + np.uint64(step + 1))


def _unit(salted: np.ndarray) -> np.ndarray:
    return ((_mix(salted) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def uniform(rows: np.ndarray, seed: int, step: int) -> np.ndarray:
    """A number in (0, 1) per content hash, another one for each seed and step."""
    return _unit(rows ^ _salts(np.array([seed]), step))


def _vectors(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    """A column of arrays as rows x d."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sorted(table: pa.Table, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(models, candidates) in the order of (model, x)."""
    ids, X = table["model"].to_numpy(), _vectors(table["x"], d)
    order = np.lexsort([*X.T[::-1], ids])
    return ids[order], X[order]


def _column(v: np.ndarray) -> pa.Array:
    if v.ndim == 1:
        return pa.array(v)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * v.shape[1]), pa.array(np.ascontiguousarray(v).ravel()))


class _Starts:
    """One pass over ``specs`` (key -> (k, seed)); ``blocks`` holds (block, n, x, w)."""

    def __init__(self, spark: SparkSession, blocks: DataFrame, d: int, specs: Mapping):
        self.spark, self.blocks, self.d = spark, blocks, d
        self.models = [(m, k, seed) for m, (k, seed) in enumerate(specs.values())]
        size = np.cumsum([k for _, k, _ in self.models])
        group = max(1, min(GROUP, GROUP_NUMBERS // d))
        groups = [(m, int(s // group), k, seed) for (m, k, seed), s in zip(self.models, size)]
        self.spec = spark.createDataFrame(groups, "model long, g long, k long, seed long")
        # all candidates of the pass, about 4k a model, travel to every task
        self.light = 9 * int(size[-1] if len(size) else 0) * 4 * (d + 1) <= BROADCAST
        self.held: list[str] = []
        self.shared: list = []

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        with arrow_rows(self.spark, 8), fine_parts(self.spark, self.d):
            table, place = stored(self.spark, df, name)
        self.held.append(place)
        return table

    def _listed(self, cands: DataFrame) -> DataFrame:
        """Every group of models as one row (g, ids, cs), candidates sorted by (model, x)."""
        d = self.d

        def lists(table: pa.Table) -> pa.Table:
            ids, X = _sorted(table, d)
            return pa.table({"g": table["g"][:1], "ids": pa.array([ids.tobytes()], pa.binary()), "cs": pa.array([X.tobytes()], pa.binary())})

        mine = cands.join(F.broadcast(self.spec.select("model", "g")), "model").select("g", "model", "x")
        return mine.groupBy("g").applyInArrow(lists, "g long, ids binary, cs binary")

    def _beside(self, cands: DataFrame) -> DataFrame:
        """Every block beside every group of models: (block, x, w, g, ids, cs)."""
        listed = self._stored(self._listed(cands), "start-groups")
        places = [r["g"] for r in self.spec.select("g").distinct().collect()]
        dealt = self.blocks.withColumn("g", F.explode(F.lit(sorted(places))))
        salt = tasks(self.spark)
        many = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        return dealt.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salt)).cast("int")).join(many, ["g", "salt"]).drop("salt")

    def _fetched(self, df: DataFrame, *before) -> tuple[np.ndarray, np.ndarray]:
        """(models, candidates) in the order of the models, after those there were."""
        with arrow_rows(self.spark, 8), fine_parts(self.spark, self.d):
            table = df.toArrow()
        ids, X = (np.concatenate(v) for v in zip(*before, (table["model"].to_numpy(), _vectors(table["x"], self.d))))
        order = np.argsort(ids, kind="stable")
        return ids[order], X[order]

    def _broadcast(self, value):
        self.shared.append(self.spark.sparkContext.broadcast(value))
        return self.shared[-1]

    def _scan(self, cands, each, kind: str) -> DataFrame:
        """``each(boxes, C, first, ids, held)`` over every block and the models; ``ids`` are the models of the lists in ``C``."""
        d, names = self.d, [c.split()[0] for c in kind.split(", ")]
        shared = self._broadcast(cands) if self.light else None

        def run(batches):
            held: dict = {}
            for batch in batches:
                for r in range(batch.num_rows):
                    x, w, *lists = (np.frombuffer(batch.column(c)[r].as_buffer(), np.int64 if c == 2 else np.float64) for c in range(batch.num_columns))
                    boxes = cut(x.reshape(-1, d), w)
                    ids, all_ = (lists[0], lists[1].reshape(-1, d)) if lists else shared.value
                    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1], True])
                    for a, b in chunks(first, boxes[0].together):
                        mine = {} if lists else held.setdefault((a, b), {})
                        out = each(boxes, all_[first[a]:first[b]], first[a:b + 1] - first[a], ids[first[a:b]], mine)
                        if len(out[0]):
                            yield pa.RecordBatch.from_arrays([_column(v) for v in out], names)

        if self.light:
            return self.blocks.select("x", "w").mapInArrow(run, kind)
        return self._beside(cands).select("x", "w", "ids", "cs").mapInArrow(run, kind)

    def run(self, steps: int) -> dict[int, np.ndarray]:
        """model -> centres."""
        specs, d = np.array([(k, seed) for _, k, seed in self.models], np.int64).reshape(-1, 2), self.d

        def costs(boxes, C, first, ids, held):
            return ids, sum((box.costs(C, first, held) for box in boxes), np.zeros(len(ids)))

        try:
            cands = self._fetched(self._first()) if self.light else self._stored(self._first(), "start-cands")
            for step in range(1, steps + 1):
                cost = self._scan(cands, costs, "model long, c double")
                phi = np.full(len(specs), np.inf)
                with arrow_rows(self.spark, 8), fine_parts(self.spark, self.d):
                    for r in cost.groupBy("model").agg(F.sum("c").alias("c")).collect():
                        phi[r["model"]] = r["c"] if r["c"] > 0 else np.inf

                def sample(boxes, C, first, ids, held, step=step, phi=phi):
                    salts, models, found = _salts(specs[ids, 1], step), [np.zeros(0, np.int64)], [np.zeros((0, d))]
                    for box in boxes:
                        m, rows = box.drawn(C, first, 2.0 * specs[ids, 0], phi[ids], salts, content_hash(box.rows[:box.n]), _mix, held)
                        models.append(ids[m])
                        found.append(box.rows[rows])
                    return np.concatenate(models), np.concatenate(found)

                more = self._scan(cands, sample, "model long, x array<double>")
                cands = self._fetched(more, cands) if self.light else self._stored(cands.unionByName(more), "start-cands")
            return self._reduced_here(*cands) if self.light else self._reduced(cands)
        finally:
            for shared in self.shared:
                shared.destroy()
            for place in self.held:
                drop_stored(self.spark, place)

    def _first(self) -> DataFrame:
        """One row per model, drawn uniformly: the first to arrive in a race of exponential clocks at the rows' weights."""
        d, models = self.d, self.models

        def pick(batches):
            best: dict = {}
            for pdf in batches:
                for x, w in zip(pdf["x"], pdf["w"]):
                    X, w = matrix(x, d), np.frombuffer(w, np.float64)
                    # of rows of one weight the one with the largest number is first
                    order = np.argsort(w, kind="stable")
                    rows, some = content_hash(X)[order], np.flatnonzero(np.r_[True, np.diff(w[order]) > 0])
                    ends, weights = np.append(some[1:], len(w)), w[order[some]]
                    step = max(1, DRAWS // len(w))
                    for at in range(0, len(models), step):
                        part = models[at:at + step]
                        drawn = _mix(rows ^ _salts(np.array([seed for _, _, seed in part]), 0)[:, None])
                        top = np.maximum.reduceat(drawn >> np.uint64(11), some, axis=1) if len(some) > 1 else (drawn.max(axis=1) >> np.uint64(11))[:, None]
                        t = -np.log((top.astype(np.float64) + 0.5) * 2.0 ** -53) / weights
                        for i, (j, (m, _, _)) in enumerate(zip(t.argmin(axis=1), part)):
                            if m not in best or t[i, j] < best[m][0]:
                                row = order[some[j] + int(drawn[i, some[j]:ends[j]].argmax())]
                                best[m] = (float(t[i, j]), X[row].tolist())
            yield pd.DataFrame([(m, t, x) for m, (t, x) in best.items()], columns=["model", "t", "x"])

        races = self.blocks.select("x", "w").mapInPandas(pick, "model long, t double, x array<double>")
        return races.groupBy("model").agg(F.min_by("x", "t").alias("x"))

    def _reduced(self, cands: DataFrame) -> dict[int, np.ndarray]:
        known, d = {m: (k, seed) for m, k, seed in self.models}, self.d

        def weigh(boxes, C, first, ids, held):
            n = np.zeros((len(C), 1))
            for box in boxes:
                box.add_sums(C, first, n, held)
            n = n[:, 0]
            used = np.flatnonzero(n)
            at = np.searchsorted(first, used, side="right") - 1
            return ids[at], used - first[at], n[used]

        weights = self._scan(cands, weigh, "model long, at long, w double").groupBy("model", "at").agg(F.sum("w").alias("w"))

        def reduce(mine: pa.Table, weights: pa.Table) -> pa.Table:
            ids, X = _sorted(mine, d)
            w = np.zeros(len(X))
            w[weights["at"].to_numpy()] = weights["w"].to_numpy()
            model = int(ids[0])
            C = weighted_kmeans_pp(X, w, *known[model])
            return pa.table({"model": pa.array([model]), "c": pa.array([C.tobytes()], pa.binary())})

        # a fixed number of parts: few and small groups would be merged into one task
        cands, weights = (t.repartition(tasks(self.spark), "model") for t in (cands, weights))
        found = cands.groupBy("model").cogroup(weights.groupBy("model")).applyInArrow(reduce, "model long, c binary")
        with arrow_rows(self.spark, 8), fine_parts(self.spark, self.d):
            found = found.toArrow()
        return {m: matrix(c, d) for m, c in zip(found["model"].to_pylist(), found["c"].to_pylist())}


    def _reduced_here(self, ids: np.ndarray, X: np.ndarray) -> dict[int, np.ndarray]:
        """:meth:`_reduced` of candidates that all tasks have."""
        sc, d = self.spark.sparkContext, self.d
        first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1], True]) if len(ids) else np.zeros(1, np.int64)
        X = np.concatenate([np.zeros((0, d)), *[X[a:b][np.lexsort(X[a:b].T[::-1])] for a, b in zip(first, first[1:])]])
        shared = self._broadcast((first, X))

        def weigh(batches):
            first, X = shared.value
            total, held = np.zeros((len(X), 1)), {}
            for pdf in batches:
                for x, w in zip(pdf["x"], pdf["w"]):
                    boxes = cut(matrix(x, d), np.frombuffer(w, np.float64))
                    for a, b in chunks(first, boxes[0].together):
                        part, mine = slice(first[a], first[b]), held.setdefault((a, b), {})
                        for box in boxes:
                            box.add_sums(X[part], first[a:b + 1] - first[a], total[part], mine)
            yield from parts_of(total, PIECE)

        parts, w = self.blocks.select("x", "w").mapInPandas(weigh, "part long, task int, at binary, sums binary"), np.zeros(len(X))
        for _, at, piece in added(self.spark, parts, PIECE, 1, d):
            w[at] = piece[:, 0]
        weights = self._broadcast(w)
        known = {m: (k, seed) for m, k, seed in self.models}
        jobs = [(int(ids[a]), int(a), int(b), *known[int(ids[a])]) for a, b in zip(first, first[1:])]
        jobs.sort(key=lambda job: -job[3])
        # large and small models dealt alike
        many = max(1, min(len(jobs), 4 * tasks(self.spark)))

        def reduce(mine):
            for job in mine:
                for m, a, b, k, seed in job:
                    yield m, weighted_kmeans_pp(shared.value[1][a:b], weights.value[a:b], k, seed).tobytes()

        return {m: matrix(c, d) for m, c in sc.parallelize([jobs[i::many] for i in range(many)], many).mapPartitions(reduce).collect()}


def weighted_kmeans_pp(C: np.ndarray, w: np.ndarray, k: int, seed: int, iters: int = 30) -> np.ndarray:
    """Weighted k-means++ and Lloyd on one model's candidates."""
    rng = np.random.default_rng(seed)
    if C.shape[0] <= k:
        extra = C[rng.integers(0, C.shape[0], k - C.shape[0])]
        return np.vstack([C, extra])[:k]
    w = np.where(w > 0, w, 1e-12)
    d = C.shape[1]
    columns = [np.ascontiguousarray(x) for x in C.T] if d < WIDE - 1 else []

    def apart(i: int) -> np.ndarray:
        """Squared distances to a candidate."""
        if not columns:
            return ((C - C[i]) ** 2).sum(1)
        out = columns[0] - columns[0][i]
        out *= out
        for x in columns[1:]:
            gap = x - x[i]
            gap *= gap
            out += gap
        return out

    def pick(p: np.ndarray) -> int:
        """``rng.choice(len(p), p=p)`` without its checks."""
        ends = p.cumsum()
        ends /= ends[-1]
        return int(ends.searchsorted(rng.random(), side="right"))

    places = [pick(w / w.sum())]
    d2 = apart(places[0])
    for _ in range(1, k):
        p = w * d2
        total = p.sum()
        if total > 0:
            p /= total
            places.append(pick(p))
        else:
            places.append(int(rng.integers(len(C))))
        np.minimum(d2, apart(places[-1]), out=d2)
    M = C[places]
    boxes = None
    if k >= BOXED and d < WIDE:
        order = box_order(C)
        boxes = Boxes(C[order], w[order])
    for _ in range(iters):
        if boxes is not None:
            total, _ = boxes.assigned_sums(M, np.array([0, k]))
            size, total = total[:, 0], total[:, 1:]
        else:
            _, a = next(nearest_each(C, M, np.array([0, k])))
            size = np.bincount(a, weights=w, minlength=k)
            total = np.stack([np.bincount(a, weights=w * C[:, i], minlength=k) for i in range(d)], axis=1)
        new = np.where(size[:, None] > 0, total / np.maximum(size, 1e-300)[:, None], M)
        if np.allclose(new, M):
            break
        M = new
    return M


def kmeans_parallel_init(data: DataFrame, cols, specs: Mapping[object, tuple[int, int]], steps: int = 2) -> dict[object, list[list[float]]]:
    """k-means|| starts for several models; ``specs`` maps key -> (k, seed)."""
    flat, d, arr = _flat(data, cols)
    blocks, place = pack(data.sparkSession, flat, d, arr)
    try:
        return {key: C.tolist() for key, C in _starts(data.sparkSession, blocks, d, specs, steps).items()}
    finally:
        drop_stored(data.sparkSession, place)


def _starts(spark: SparkSession, blocks: DataFrame, d: int, specs: Mapping, steps: int) -> dict[object, np.ndarray]:
    found = _Starts(spark, blocks, d, specs).run(steps)
    return {key: found[m] for m, key in enumerate(specs) if m in found}


def _passes(specs: Mapping, centers: int) -> list[dict]:
    """``specs`` in parts of at most ``MODELS`` models and ``centers`` centres, if one model has no more."""
    out: list[dict] = [{}]
    held = 0
    for key, (k, seed) in specs.items():
        if out[-1] and (len(out[-1]) >= MODELS or held + k > centers):
            out.append({})
            held = 0
        out[-1][key] = (k, seed)
        held += k
    return out


def fit_restarts(data: DataFrame, cols, k_values: Sequence[int], runs: int = 10,
                 tol: float = 1e-6, max_iter: int = 20, seed: int = 1,
                 steps: int = 2, count: ScanCount | None = None) -> dict[int, KMeansResult]:
    """Best-of-``runs`` k-means per k; every run of every k shares each scan. No rows: no fits."""
    spark = data.sparkSession
    flat, d, arr = _flat(data, cols)
    xs = ArrayVec("_arr", d) if arr else [f"_f{i}" for i in range(d)]
    blocks, place = pack(spark, flat, d, arr)
    best: dict[int, KMeansResult] = {}
    try:
        specs = {(k, r): (k, seed + 1000 * k + r) for k in k_values for r in range(runs) if k > 1}
        for some in _passes(specs, NUMBERS // (d + 1)):
            inits: dict = {}
            # a model of k centres has about 4k candidates
            for part in _passes(some, BROADCAST // (8 * (d + 1)) * 2 // 9):
                inits.update(_starts(spark, blocks, d, part, steps) if part else {})
            if 1 in k_values and not best:
                column = [F.avg(F.col("_arr").getItem(i)) if arr else F.avg(x) for i, x in enumerate(range(d) if arr else xs)]
                mean = flat.select(*column).first()
                if mean[0] is not None:
                    inits[(1, 0)] = [[float(v) for v in mean]]
            if not inits:
                continue
            for (k, _), res in bounded_lloyd(spark, blocks, d, inits, max_iter, tol, count, best=lambda key: key[0]).items():
                if k not in best or res.cost < best[k].cost:
                    best[k] = res
    finally:
        drop_stored(spark, place)
    return dict(sorted(best.items()))

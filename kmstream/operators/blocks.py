"""Rows in blocks, and Lloyd iterations that assign boxes of rows at once.

Fits that scan the same rows many times read them as blocks: equal rows are one row
with a weight, and up to ``ROWS`` of them are one binary matrix. Rows are dealt to blocks
along a Z-order curve and ordered inside a block by halving it, so that a block and its
parts are small boxes. Rows of ``boxes.WIDE`` and more columns are dealt by the columns of
few values first, as long as ``CELL`` rows agree in them on average. Narrow rows of which ``CELL``
agree in all columns but one are dealt as lines along that column (``functions.lines``), whose search
takes little more for long lines than for short ones: their blocks have up to ``LINE_ROWS`` rows.
Blocks are dealt over all cores, since a scan is arithmetic, not reading.

``bounded_lloyd`` searches the boxes (``functions.boxes``): one whose rows can only have
one nearest centre adds its sums, the rows of the others are compared with the centres
that remain. The blocks are written once and only read by the scans; no state goes from
one scan to the next but the centres. Of several runs of a model only the best one's distances are added up.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass
from typing import Callable, Mapping

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kmstream.functions.boxes import WIDE, box_order, chunks, cut
from kmstream.operators.cluster import KMeansResult, _flat, batch_matrix
from kmstream.session import drop_stored, stored

#: Rows of a block, and most rows of a block of lines.
ROWS, LINE_ROWS = 4096, 65_536
#: Rows that agree in the leading columns, on average, and distinct values up to which a column may lead.
CELL, FEW = 64, 256
#: A scan serves so many models and sums of so many numbers; larger sweeps take several passes.
MODELS, NUMBERS = 16_384, 1 << 23
#: Numbers of the pieces in which the tasks' sums are added up; columns of their own are slow for wide rows.
PIECE = 1 << 15


@contextmanager
def _set(spark: SparkSession, name: str, value: str | None):
    """A setting for the jobs inside; the session's own one comes back."""
    before = spark.conf.get(name, None)
    if value is not None:
        spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def arrow_rows(spark: SparkSession, rows: int):
    """Arrow batches of so many rows for the jobs inside."""
    return _set(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def fine_parts(spark: SparkSession, d: int):
    """Files of narrow blocks are read by several tasks a core, since some blocks take several times as long as others.

    Wide blocks take alike, and every task sends sums of all centres and columns.
    """
    return _set(spark, "spark.sql.files.minPartitionNum", str(4 * spark.sparkContext.defaultParallelism) if d < WIDE else None)


def tasks(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _leading(weighed: DataFrame, xs: list, distinct: list[int], n: int) -> list[int]:
    """The columns of few values that rows are dealt by first: as many as leave ``CELL`` rows to a combination."""
    few = sorted((i for i, v in enumerate(distinct) if v <= FEW), key=lambda i: (distinct[i], i))
    lengths = sorted({int(v) for v in np.linspace(1, len(few), min(len(few), 16))}) if few else []
    if not lengths:
        return []
    cells = weighed.agg(*[F.approx_count_distinct(F.xxhash64(*[xs[i] for i in few[:v]])) for v in lengths]).first()
    return few[:max([v for v, c in zip(lengths, cells) if c * CELL <= n], default=0)]


def _lined(weighed: DataFrame, xs: list, distinct: list[int], n: int) -> list[int]:
    """All columns but the one of most values, if ``CELL`` rows agree in them on average; else none."""
    others = sorted(range(len(xs)), key=lambda i: (distinct[i], i))[:-1]
    if not others or max(distinct[i] for i in others) * CELL > n:
        return []
    cells = 1.0
    for i in others:
        cells *= max(1, distinct[i])
    if cells * CELL > n:
        cells = weighed.agg(F.approx_count_distinct(F.xxhash64(*[xs[i] for i in others]))).first()[0]
    return others if cells * CELL <= n else []


def _curve(names: list[str], array: bool, low: list[float], high: list[float], free: list[int]):
    """The place of a row on a Z-order curve through the box from ``low`` to ``high`` in the columns ``free``; 62 of them at most are used."""
    free = free[:62]
    d = len(free)
    bits = max(1, 62 // max(1, d))
    low, span = np.array(low)[free], np.array(high)[free] - np.array(low)[free]

    @F.pandas_udf("long")
    def place(*cols: pd.Series) -> pd.Series:
        X = batch_matrix(pd.DataFrame(dict(zip(names, cols))), len(cols) if not array else len(cols[0].iat[0]) if len(cols[0]) else len(free), array)
        X = X[:, free] if len(X) else np.zeros((0, d))
        with np.errstate(all="ignore"):
            part = np.nan_to_num((X - low) / np.where(span > 0, span, 1.0), nan=0.0, posinf=1.0, neginf=0.0)
        cell = np.minimum((np.clip(part, 0.0, 1.0) * 2.0 ** bits).astype(np.int64), 2 ** bits - 1)
        out = np.zeros(len(X), np.int64)
        for b in range(bits - 1, -1, -1):
            for i in range(d):
                out = (out << 1) | ((cell[:, i] >> b) & 1)
        return pd.Series(out)

    return place(*[F.col(c) for c in names])


def pack(spark: SparkSession, flat: DataFrame, d: int, array: bool) -> tuple[DataFrame, str]:
    """((block, n, x, w), folder): the distinct rows of ``flat`` (``cluster._flat``) with their counts, in blocks."""
    names = ["_arr"] if array else [f"_f{i}" for i in range(d)]

    def run(batches):
        xs, ws, held = [], [], 0
        for pdf in batches:
            xs.append(batch_matrix(pdf, d, array))
            ws.append(pdf["_w"].to_numpy(np.float64))
            held += len(pdf)
            while held >= rows:
                X, w = np.concatenate(xs), np.concatenate(ws)
                yield _block(X[:rows], w[:rows], lead, lined)
                xs, ws, held = [X[rows:]], [w[rows:]], held - rows
        if held:
            yield _block(np.concatenate(xs), np.concatenate(ws), lead, lined)

    # read twice: for the ranges of the columns and for the blocks
    weighed, place = stored(spark, flat.groupBy(*names).agg(F.count(F.lit(1)).alias("_w")), "rows")
    try:
        xs = [F.col("_arr").getItem(i) if array else F.col(c) for i, c in enumerate(names * d if array else names)]
        ends = weighed.agg(*[F.min(x) for x in xs], *[F.max(x) for x in xs], *[F.approx_count_distinct(x) for x in xs], F.count(F.lit(1))).first()
        low, high = ([float(v or 0.0) for v in part] for part in (ends[:d], ends[d:2 * d]))
        distinct, n = list(ends[2 * d:3 * d]), int(ends[-1])
        # in few columns small cubes leave less to search than long cells, but for lines of many rows
        lead = _leading(weighed, xs, distinct, n) if d >= WIDE else _lined(weighed, xs, distinct, n)
        lined, cores = d < WIDE and bool(lead), spark.sparkContext.defaultParallelism
        rows = min(LINE_ROWS, max(ROWS, n // (4 * cores))) if lined else ROWS
        parts = max(tasks(spark), min(4 * cores, n // ROWS)) if lined else tasks(spark)
        # rows of one place on the curve may fall in several parts: the columns themselves decide
        order = [*[f"_k{i}" for i in lead], "_z", *names]
        dealt = (weighed.withColumns({"_z": _curve(names, array, low, high, [i for i in range(d) if i not in lead]), **{f"_k{i}": xs[i] for i in lead}})
                 .repartitionByRange(parts, *order).sortWithinPartitions(*order).select(*names, "_w"))
        blocks = dealt.mapInPandas(run, "n int, x binary, w binary").withColumn("block", F.monotonically_increasing_id())
        return stored(spark, blocks, "blocks")
    finally:
        drop_stored(spark, place)


def _block(X: np.ndarray, w: np.ndarray, lead: list[int], lined: bool) -> pd.DataFrame:
    if not lined:       # lines come sorted
        ends = [0, *(np.flatnonzero((X[1:, lead] != X[:-1, lead]).any(axis=1)) + 1).tolist(), len(X)]
        order = np.concatenate([a + box_order(X[a:b]) for a, b in zip(ends, ends[1:])])
        X, w = X[order], w[order]
    return pd.DataFrame({"n": np.array([len(X)], np.int32), "x": [(X + 0.0).tobytes()], "w": [w.tobytes()]})


def matrix(x: bytes, d: int) -> np.ndarray:
    return np.frombuffer(x, np.float64).reshape(-1, d)


@dataclass
class ScanCount:
    """Row-and-model pairs seen and searched, over all scans; skipped ones cost no distance to other centres."""

    pairs: int = 0
    searched: int = 0

    @property
    def skipped(self) -> float:
        return 1.0 - self.searched / self.pairs if self.pairs else 0.0


def firsts(C: list) -> np.ndarray:
    """The place of each model's first centre in the list of all, and the length of the list."""
    return np.cumsum([0, *map(len, C)])


def _summed(lines: int, width: int):
    def summed(pdf: pd.DataFrame) -> pd.DataFrame:
        """The tasks' sums of one part added up, in the order of the tasks."""
        pdf, total = pdf.sort_values("task"), np.zeros((lines, width))
        for at, x in zip(pdf["at"], pdf["sums"]):
            total[np.frombuffer(at, np.int32)] += matrix(x, width)
        at = np.flatnonzero(total[:, 0]).astype(np.int32)
        return pd.DataFrame({"part": [pdf["part"].iat[0]], "at": [at.tobytes()], "sums": [total[at].tobytes()]})

    return summed


def parts_of(total: np.ndarray, lines: int):
    """The lines of a task's sums that are not empty, in pieces (part, task, at, sums)."""
    task, used = TaskContext.get().partitionId(), np.flatnonzero(total[:, 0])
    ends = np.searchsorted(used, np.arange(0, len(total) + lines, lines))
    for part, (a, b) in enumerate(zip(ends, ends[1:])):
        if b > a:
            at = used[a:b]
            yield pd.DataFrame({"part": [part], "task": [task], "at": [(at - part * lines).astype(np.int32).tobytes()], "sums": [total[at].tobytes()]})


def added(spark: SparkSession, parts: DataFrame, lines: int, width: int, d: int):
    """(part, lines, sums) of all tasks' pieces, added up in Spark."""
    with arrow_rows(spark, 8), fine_parts(spark, d):
        found = parts.groupBy("part").applyInPandas(_summed(lines, width), "part long, at binary, sums binary").toArrow()
    for part, at, piece in zip(found["part"].to_pylist(), found["at"], found["sums"]):
        yield part, part * lines + np.frombuffer(at.as_buffer(), np.int32), matrix(piece.as_buffer(), width)


def bounded_lloyd(spark: SparkSession, blocks: DataFrame, d: int, inits: Mapping, max_iter: int = 20, tol: float = 1e-6,
                  count: ScanCount | None = None, score: bool = True, best: Callable | None = None) -> dict[object, KMeansResult]:
    """Lloyd iterations of several models from given starts; the same centres as ``cluster.lloyd``, with fewer distances.

    A model rests when no centre moved by more than ``tol``; an empty cluster keeps its centre. With ``best``, a
    function of the key, only the model of the lowest cost is returned for each of its values (the first one if equal).
    """
    keys = list(inits)
    C = [np.asarray(inits[key], np.float64).reshape(-1, d) for key in keys]
    iterations = [0] * len(keys)
    active = list(range(len(C)))

    def shared_centers(order: list[int]):
        return spark.sparkContext.broadcast((np.concatenate([C[m] for m in order]), firsts([C[m] for m in order])))

    def scan(order: list[int], final: bool) -> tuple[np.ndarray, np.ndarray]:
        """(centres in use by place, their sums): weight and sums by column, or weight, cost and sum of distances."""
        names = ["m", "cost", "sdist"] if final else ["m", *[f"s{i}" for i in range(d)]]
        lines = max(1, PIECE // len(names))
        shared = shared_centers(order)

        def run(batches):
            all_, first = shared.value
            total, pairs, searched, held = np.zeros((len(all_), len(names))), 0, 0, {}
            for pdf in batches:
                for x, w in zip(pdf["x"], pdf["w"]):
                    boxes = cut(matrix(x, d), np.frombuffer(w, np.float64))
                    pairs += sum(box.n for box in boxes) * (len(first) - 1)
                    for a, b in chunks(first, boxes[0].together):
                        part, own = slice(first[a], first[b]), first[a:b + 1] - first[a]
                        mine = held.setdefault((a, b), {})
                        if not final:
                            searched += sum(box.add_sums(all_[part], own, total[part], mine) for box in boxes)
                            continue
                        for box, rows, cen, d2 in ((box, *piece) for box in boxes for piece in box.scored(all_[part], own, mine)):
                            wide, at = box.w[rows].ravel(), cen.ravel()
                            for c, v in enumerate((wide, wide * d2.ravel(), wide * np.sqrt(d2).ravel())):
                                total[part, c] += np.bincount(at, weights=v, minlength=int(own[-1]))
            yield from parts_of(total, lines)
            if pairs and not final:
                seen = np.zeros(len(names))
                seen[:2] = pairs, searched
                yield pd.DataFrame({"part": [-1], "task": [TaskContext.get().partitionId()], "at": [np.zeros(1, np.int32).tobytes()], "sums": [seen.tobytes()]})

        parts = blocks.select("x", "w").mapInPandas(run, "part long, task int, at binary, sums binary")
        total = np.zeros((sum(len(C[m]) for m in order), len(names)))
        for part, at, piece in added(spark, parts, lines, len(names), d):
            if part >= 0:
                total[at] = piece
            elif count is not None:
                count.pairs += int(piece[0, 0])
                count.searched += int(piece[0, 1])
        shared.destroy()
        at = np.flatnonzero(total[:, 0] > 0)
        return at, total[at]

    def costs() -> np.ndarray:
        """Every model's cost."""
        shared = shared_centers(list(range(len(C))))

        def run(batches):
            all_, first = shared.value
            total, held = np.zeros(len(first) - 1), {}
            for pdf in batches:
                for x, w in zip(pdf["x"], pdf["w"]):
                    boxes = cut(matrix(x, d), np.frombuffer(w, np.float64))
                    for a, b in chunks(first, boxes[0].together):
                        for box in boxes:
                            total[a:b] += box.costs(all_[first[a]:first[b]], first[a:b + 1] - first[a], held.setdefault((a, b), {}))
            yield pd.DataFrame({"task": [TaskContext.get().partitionId()], "costs": [total.tobytes()]})

        with arrow_rows(spark, 8), fine_parts(spark, d):
            found = blocks.select("x", "w").mapInPandas(run, "task int, costs binary").toArrow()
        shared.destroy()
        order = np.argsort(found["task"].to_numpy())
        return sum((np.frombuffer(found["costs"][int(i)].as_py(), np.float64) for i in order), np.zeros(len(C)))

    for _ in range(max_iter):
        if not active:
            break
        first = firsts([C[m] for m in active])
        old = np.concatenate([C[m] for m in active])
        at, sums = scan(active, False)
        new = old.copy()
        new[at] = sums[:, 1:] / sums[:, :1]
        far = np.maximum.reduceat(((new - old) ** 2).sum(axis=1), first[:-1])
        for m, a, b in zip(active, first, first[1:]):
            C[m] = new[a:b]
            iterations[m] += 1
        active = [m for m, moved in zip(active, far) if moved > tol * tol]
    chosen = list(range(len(C)))
    if best is not None and len({best(key) for key in keys}) < len(keys):
        cost, first_of = costs(), {}
        for m, key in enumerate(keys):
            held = first_of.setdefault(best(key), m)
            if cost[m] < cost[held]:
                first_of[best(key)] = m
        chosen = sorted(first_of.values())
    results = {keys[m]: KMeansResult(C[m].tolist(), iterations[m]) for m in chosen}
    if score and chosen:
        at, sums = scan(chosen, True)
        first = firsts([C[m] for m in chosen])
        whole = np.zeros((int(first[-1]), 3))
        whole[at] = sums
        for m, a, b in zip(chosen, first, first[1:]):
            r, part = results[keys[m]], whole[a:b]
            r.sizes = [int(n) for n in part[:, 0]]
            r.n, r.cost, r.sum_dist = sum(r.sizes), float(part[:, 1].sum()), float(part[:, 2].sum())
    return results


def sweep_lloyd(data: DataFrame, cols, inits: Mapping, max_iter: int = 20, tol: float = 1e-6, score: bool = True) -> dict[object, KMeansResult]:
    """``cluster.lloyd`` for sweeps over many models: the rows are put in blocks first."""
    flat, d, array = _flat(data, cols)
    for key, c in inits.items():
        if any(len(row) != d for row in c):
            raise ValueError(f"model {key!r}: centres of another width than the data's {d}")
    blocks, place = pack(data.sparkSession, flat, d, array)
    try:
        return bounded_lloyd(data.sparkSession, blocks, d, inits, max_iter, tol, score=score)
    finally:
        drop_stored(data.sparkSession, place)

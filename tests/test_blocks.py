"""Block table, bounded Lloyd and random starts: the plain scan's centres, whatever the partitions and batches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kmstream.functions.vectors import ArrayVec, nearest_centers, nearest_two
from kmstream.operators import blocks, restarts
from kmstream.operators.cluster import _flat, lloyd


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(4)
    X = np.concatenate([rng.normal(c, 0.5, (300, 2)) for c in ((0, 0), (3, 1), (1, 4))])
    X[:200] = X[0]                       # one point many times
    X[200:260] = np.round(X[200:260])    # ties
    return X


@pytest.fixture(scope="module")
def frame(spark, points):
    rows = [*points.tolist(), [None, 1.0], [float("nan"), 2.0]]
    return spark.createDataFrame(rows, "a double, b double").repartition(3)


SPECS = {(k, r): (k, 31 * k + r) for k in (2, 5, 12) for r in range(2)}


def test_blocks_hold_distinct_rows_with_their_counts(spark, frame, points):
    flat, d, arr = _flat(frame, ["a", "b"])
    table, _ = blocks.pack(spark, flat, d, arr)
    rows = table.collect()
    X = np.concatenate([blocks.matrix(r["x"], d) for r in rows])
    w = np.concatenate([np.frombuffer(r["w"], np.float64) for r in rows])
    want, n = np.unique(points, axis=0, return_counts=True)
    order = np.lexsort(X.T[::-1])
    assert np.array_equal(X[order], want) and np.array_equal(w[order], n)
    assert all(r["n"] <= blocks.ROWS for r in rows)


@pytest.mark.parametrize("array", [False, True])
def test_bounded_scans_find_the_plain_scans_centres(spark, frame, array):
    data = frame.select(F.array("a", "b").alias("v")) if array else frame
    cols = ArrayVec("v", 2) if array else ["a", "b"]
    inits = restarts.kmeans_parallel_init(data, cols, SPECS)
    inits["far"] = [[0.0, 0.0], [100.0, 100.0], [0.0, 0.0]]      # an empty cluster and a tie of centres
    plain = lloyd(data, cols, inits, max_iter=20, tol=1e-6)
    count = blocks.ScanCount()
    flat, d, arr = _flat(data, cols)
    bounded = blocks.bounded_lloyd(spark, blocks.pack(spark, flat, d, arr)[0], d, inits, 20, 1e-6, count)
    for key in inits:
        assert np.allclose(plain[key].centers, bounded[key].centers, rtol=0, atol=1e-9)
        assert (plain[key].sizes, plain[key].n, plain[key].iterations) == (bounded[key].sizes, bounded[key].n, bounded[key].iterations)
        assert plain[key].cost == pytest.approx(bounded[key].cost) and plain[key].sum_dist == pytest.approx(bounded[key].sum_dist)
    assert count.skipped > 0.5


def test_starts_depend_on_neither_partitions_nor_batches(spark, frame):
    one = restarts.kmeans_parallel_init(frame, ["a", "b"], SPECS)
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        for c, v in zip(before, ("3", "17")):
            spark.conf.set(c, v)
        assert restarts.kmeans_parallel_init(frame.repartition(7), ["a", "b"], SPECS) == one
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "17"
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_candidates_meet_salted_blocks_beyond_the_broadcast_bound(spark, frame, monkeypatch):
    one = restarts.kmeans_parallel_init(frame, ["a", "b"], SPECS)
    monkeypatch.setattr(restarts, "BROADCAST", 0)
    monkeypatch.setattr(restarts, "GROUP", 6)
    assert restarts.kmeans_parallel_init(frame, ["a", "b"], SPECS) == one


def test_passes_and_odd_tables(spark, frame, monkeypatch):
    monkeypatch.setattr(restarts, "MODELS", 3)
    fits = restarts.fit_restarts(frame, ["a", "b"], [1, 2, 3], runs=2)
    assert list(fits) == [1, 2, 3] and all(f.n == 900 and sum(f.sizes) == 900 for f in fits.values())
    assert fits[1].cost > fits[2].cost > fits[3].cost
    assert restarts.fit_restarts(frame.limit(0), ["a", "b"], [1, 2], runs=2) == {}
    few = restarts.fit_restarts(spark.createDataFrame([(1.0, 2.0)] * 5, "a double, b double"), ["a", "b"], [1, 3], runs=1)
    assert few[3].cost == 0.0 and few[3].n == 5


def test_lower_bound_of_the_second_nearest():
    rng = np.random.default_rng(8)
    X, C = rng.normal(size=(500, 3)), rng.normal(size=(9, 3))
    C[3] = C[7]
    X[:9] = C
    a, d2, other = nearest_two(X, C)
    full = ((X[:, None] - C[None]) ** 2).sum(-1)
    assert np.array_equal(a, nearest_centers(X, C)[0])
    full[np.arange(len(X)), a] = np.inf
    assert (other <= full.min(1) + 1e-12).all() and (other >= full.min(1) - 1e-9).all()


def test_narrow_blocks_are_read_in_finer_parts_and_settings_come_back(spark):
    from kmstream.operators.blocks import fine_parts
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    with fine_parts(spark, 5):
        assert int(spark.conf.get(name)) > spark.sparkContext.defaultParallelism
    assert spark.conf.get(name, None) == before
    with fine_parts(spark, 64):
        assert spark.conf.get(name, None) == before

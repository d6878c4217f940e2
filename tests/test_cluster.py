"""F-1..F-21: Lloyd, assignment, scores, entropy, anomalies (brute force on small data)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kmstream.functions.vectors import ArrayVec, nearest_centers, sq_distance, with_assignment
from kmstream.operators.anomaly import AnomalyDetector, topn_threshold
from kmstream.operators.cluster import (assemble, fit_kmeans, label_counts, lloyd, mean_centers,
                                        score_centers)
from kmstream.operators.score import cluster_label_count, label_entropy, weighted_entropy


def np_lloyd(X, C, iters):
    C = np.array(C, dtype=float)
    for _ in range(iters):
        d2 = ((X[:, None, :] - C[None, :, :]) ** 2).sum(-1)
        a = d2.argmin(1)
        for j in range(len(C)):
            if (a == j).any():
                C[j] = X[a == j].mean(0)
    return C


@pytest.fixture(scope="module")
def pts(spark):
    rng = np.random.default_rng(3)
    X = np.vstack([rng.normal(0, 1, (60, 2)), rng.normal(6, 1, (40, 2)), rng.normal((0, 8), 1, (30, 2))])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(X)],
                               "id long, x double, y double")
    return X, df


def test_lloyd_matches_numpy(pts):
    X, df = pts
    starts = X[:3].tolist()
    res = lloyd(df, ["x", "y"], {3: starts}, max_iter=5, tol=0.0)[3]
    assert np.allclose(res.centers, np.array(np_lloyd(X, starts, 5)))
    assert sum(res.sizes) == len(X) and res.n == len(X)


def test_many_models_share_scans_and_match_single(pts):
    X, df = pts
    starts = X[:8].tolist()
    many = lloyd(df, ["x", "y"], {k: starts[:k] for k in range(1, 9)}, max_iter=4, tol=0.0)
    for k in (2, 5):
        one = lloyd(df, ["x", "y"], {k: starts[:k]}, max_iter=4, tol=0.0)[k]
        assert np.allclose(many[k].centers, one.centers)
        assert many[k].sizes == one.sizes
        assert many[k].cost == pytest.approx(one.cost)


def test_empty_cluster_keeps_centre(pts):
    X, df = pts
    far = [1000.0, 1000.0]
    res = lloyd(df, ["x", "y"], {2: [X[0].tolist(), far]}, max_iter=3, tol=0.0)[2]
    assert res.centers[1] == far and res.sizes[1] == 0


def test_dimension_mismatch_raises(pts):
    _, df = pts
    with pytest.raises(ValueError):
        lloyd(df, ["x", "y"], {2: [[0.0], [1.0]]}, max_iter=1)
    with pytest.raises(ValueError):
        sq_distance([F.col("x"), F.col("y")], [1.0])


def test_tie_goes_to_lowest_id(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "x double, y double")
    out = with_assignment(df, [F.col("x"), F.col("y")], [[1.0, 0.0], [-1.0, 0.0]]).first()
    assert out["cluster"] == 0 and out["dist"] == 1.0


def test_array_vector_path_equals_columns(pts):
    X, df = pts
    arr = df.select("id", "x", "y", F.array("x", "y").alias("v"))
    C = X[:4].tolist()
    a = with_assignment(arr, ArrayVec("v", 2), C).orderBy("id").collect()
    b = with_assignment(arr, [F.col("x"), F.col("y")], C).orderBy("id").collect()
    assert [r["cluster"] for r in a] == [r["cluster"] for r in b]
    assert np.allclose([r["dist"] for r in a], [r["dist"] for r in b])


@pytest.mark.parametrize("k", [2, 600])
def test_model_size_does_not_change_the_rule(k):
    """Grid points tie often: the lowest id wins and sums run left to right, for any k."""
    rng = np.random.default_rng(k)
    X = rng.integers(0, 4, (3000, 3)).astype(float)
    C = rng.integers(0, 4, (k, 3)) + 0.5
    d2 = np.zeros((len(X), k))
    for i in range(3):
        d2 = d2 + (X[:, i, None] - C[None, :, i]) ** 2
    cluster, best = nearest_centers(X, C)
    assert (cluster == d2.argmin(1)).all() and (best == d2.min(1)).all()


@pytest.mark.parametrize("k", [2, 600])
def test_incomplete_rows_train_nothing(spark, k):
    rows = [(float(i),) for i in range(100, 150)] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "x double")
    starts = [[100.0 + i * 50 / k] for i in range(k)]
    res = lloyd(df, ["x"], {k: starts}, max_iter=1, tol=0.0)[k]
    want = np_lloyd(np.arange(100.0, 150.0)[:, None], starts, 1)
    assert np.allclose(res.centers, want) and res.n == 50
    near = with_assignment(df, [F.col("x")], starts).filter("x is null or isnan(x)").collect()
    assert [(r["cluster"], r["dist"]) for r in near] == [(None, None)] * 2


def test_label_counts_match_brute_force(pts):
    X, df = pts
    df = df.withColumn("label", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 5).cast("string")))
    models = {k: X[:k].tolist() for k in (1, 4)}
    got = {(r["k"], r["cluster"], r["label"]): r["cnt"] for r in label_counts(df, ["x", "y"], models, "label").collect()}
    want = {}
    for k, C in models.items():
        cl, _ = nearest_centers(X, np.array(C))
        for i, c in enumerate(cl):
            at = (k, int(c), None if i % 3 == 0 else str(i % 5))
            want[at] = want.get(at, 0) + 1
    assert got == want
    scored = score_centers(df, ["x", "y"], models)
    assert scored[4].sizes == [sum(n for (k, c, _), n in want.items() if k == 4 and c == j) for j in range(4)]


def test_k1_is_mean(pts):
    X, df = pts
    assert np.allclose(mean_centers(df, ["x", "y"])[0], X.mean(0))
    res = fit_kmeans(assemble(df, ["x", "y"]), 1)
    assert np.allclose(res.centers[0], X.mean(0))


def test_best_of_runs_not_worse(pts):
    _, df = pts
    feats = assemble(df, ["x", "y"]).cache()
    single = fit_kmeans(feats, 3, runs=1, seed=5)
    best = fit_kmeans(feats, 3, runs=4, seed=5)
    assert best.cost <= single.cost + 1e-9


def test_entropy_properties(spark):
    pure = spark.createDataFrame([(0, "a")] * 5 + [(1, "b")] * 3, "cluster int, label string")
    assert weighted_entropy(pure).first()["score"] == pytest.approx(0.0)
    eq = spark.createDataFrame([(0, l) for l in "abcd"], "cluster int, label string")
    assert weighted_entropy(eq).first()["score"] == pytest.approx(math.log(4))
    le = label_entropy(eq).first()
    assert le["entropy"] == pytest.approx(math.log(4)) and le["n"] == 4
    mix = spark.createDataFrame([(0, "a"), (0, "a"), (0, "b"), (1, "c")], "cluster int, label string")
    h0 = -(2 / 3 * math.log(2 / 3) + 1 / 3 * math.log(1 / 3))
    assert weighted_entropy(mix).first()["score"] == pytest.approx(3 * h0 / 4)
    cnt = cluster_label_count(mix).collect()
    assert [(r["cluster"], r["label"], r["cnt"]) for r in cnt] == [(0, "a", 2), (0, "b", 1), (1, "c", 1)]


def test_topn_threshold_and_detector(pts):
    X, df = pts
    d = df.select("id", F.sqrt(F.col("x") ** 2 + F.col("y") ** 2).alias("dist"))
    vals = sorted(np.sqrt((X ** 2).sum(1)), reverse=True)
    assert topn_threshold(d, "dist", 10) == pytest.approx(vals[9])
    three = d.where("id < 3")
    assert topn_threshold(three, "dist", 10) == pytest.approx(np.sqrt((X[:3] ** 2).sum(1)).min())
    det = AnomalyDetector(["x", "y"], k=3, n_top=10, init="fixed", order_by="id", max_iter=5, tol=0.0)
    model = det.fit(df)
    flagged = model.transform(df).where("is_anomaly").count()
    assert flagged <= 9


def test_detector_rule_of_thumb_k(pts):
    X, df = pts
    det = AnomalyDetector(["x", "y"], k=None, n_top=5, init="k-means||", runs=2)
    assert len(det.fit(df).centers) == math.isqrt(len(X) // 2) == 8


def test_nearest_each_equals_the_plain_search_of_every_model():
    from kmstream.functions.vectors import nearest_centers, nearest_each
    rng = np.random.default_rng(5)
    X = rng.normal(size=(700, 12))
    X[:20] = X[20:40] + 1e-9                                  # rows that single precision cannot tell apart
    models = [X[:k].copy() for k in (1, 2, 3, 40, 300)] + [np.repeat(X[:3], 2, axis=0)]
    first = np.cumsum([0, *map(len, models)])
    for scale, shift in ((1.0, 0.0), (1e-30, 0.0), (1e30, 0.0), (1.0, 1e6)):
        Y, Cs = X * scale + shift, [c * scale + shift for c in models]
        got = {m: near.copy() for m, near in nearest_each(Y, np.concatenate(Cs), first)}
        for m, C in enumerate(Cs):
            assert (got[m] == nearest_centers(Y, C)[0]).all()


def test_label_counts_of_many_models_take_all_cores_and_count_null_labels(spark):
    from kmstream.functions.vectors import nearest_centers
    from kmstream.operators.cluster import label_counts
    rng = np.random.default_rng(6)
    X = rng.normal(size=(400, 2))
    labels = [None if i % 7 == 0 else f"l{i % 3}" for i in range(400)]
    df = spark.createDataFrame([(*map(float, x), v) for x, v in zip(X, labels)], "a double, b double, label string").coalesce(1)
    models = {k: X[:k].tolist() for k in (1, 2, 9)}
    want: dict = {}
    for k, C in models.items():
        for c, v in zip(nearest_centers(X, np.array(C))[0], labels):
            want[(k, int(c), v)] = want.get((k, int(c), v), 0) + 1
    counts = label_counts(df, ["a", "b"], models, "label")
    assert {(r["k"], r["cluster"], r["label"]): r["cnt"] for r in counts.collect()} == want
    assert "RoundRobinPartitioning" in counts._jdf.queryExecution().optimizedPlan().toString() \
        or "RoundRobinPartitioning" in counts._jdf.queryExecution().executedPlan().toString()

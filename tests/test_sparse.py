"""Label-encoded sparse rows against dense vectors: slots, norms, assignment and Lloyd updates."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from kmstream.operators.encode import encode_features
from kmstream.operators.sparse import sparse_assign, sparse_lloyd, sparse_rows, sparse_starts

ROWS = [(1, 0.0, 2.0, "a", "t1"), (2, 1.5, 0.0, None, "t2"), (3, -1.0, 1.0, "b", "t3"), (4, 0.0, 0.0, "", "t4"), (5, 2.0, 2.0, "a", "t5"),
        (6, 0.0, 2.0, "a", "t6"), (7, 9.0, 9.0, "b", "t7")]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS + [(8, None, 1.0, "a", "t8"), (9, float("nan"), 1.0, "a", "t9")], "i long, x double, y double, c string, label string")


def dense(rows, n):
    out = np.zeros((n, rows.width))
    for r in rows.entries.collect():
        out[r["id"] - 1, r["slot"]] = r["value"]
    return out


def test_slots_are_those_of_the_vector(spark, frame):
    rows = sparse_rows(frame, "i", ["x", "y"], ["c"], "label", include_label=True)
    whole = frame.filter("i < 8")
    vec, _ = encode_features(whole, ["x", "y"], ["c"], label="label", include_label=True)
    want = np.array([r["v"] for r in vec.select("i", vector_to_array("features").alias("v")).orderBy("i").collect()])
    assert rows.width == want.shape[1] == 2 + 4 + 7
    assert np.array_equal(dense(rows, 7), want)
    assert {r["id"]: r["norm2"] for r in rows.norms.collect()} == {i + 1: (v * v).sum() for i, v in enumerate(want)}
    bare = sparse_rows(frame, "i", ["x", "y"], [])
    assert bare.width == 2 and bare.norms.count() == 7       # a row of zeros has a norm, too
    with pytest.raises(ValueError):
        encode_features(whole, ["x"], ["c"], include_label=True)


def test_updates_match_dense_lloyd(spark, frame):
    rows = sparse_rows(frame, "i", ["x", "y"], ["c"], "label", include_label=True)
    X = dense(rows, 7)
    near = {r["id"]: (r["cluster"], r["d2"]) for r in sparse_assign(rows, sparse_starts(rows, 3), 3).collect()}
    full = ((X[:, None] - X[None, :3]) ** 2).sum(-1)
    assert {i: c for i, (c, _) in near.items()} == {i + 1: int(j) for i, j in enumerate(full.argmin(1))}
    assert np.allclose([near[i + 1][1] for i in range(7)], full.min(1))
    C = X[:3].copy()
    for _ in range(20):
        a = ((X[:, None] - C[None]) ** 2).sum(-1).argmin(1)
        new = np.array([X[a == j].mean(0) if (a == j).any() else C[j] for j in range(3)])
        if np.allclose(new, C):
            break
        C = new
    got = np.zeros((3, rows.width))
    for r in sparse_lloyd(rows, 3).collect():
        got[r["cluster"], r["slot"]] = r["value"]
    assert np.allclose(got, C)

"""The centre index against the plain search: random and tied points, equal centres, incomplete rows."""

import numpy as np
import pytest

from kmstream.functions import balls
from kmstream.functions.vectors import nearest_two


@pytest.mark.parametrize("leaf", [None, 20])
@pytest.mark.parametrize("d,k,kind", [(2, 700, "random"), (5, 900, "random"), (2, 600, "grid"), (3, 40, "random"), (1, 513, "grid"), (4, 600, "equal"), (2, 600, "far")])
def test_index_equals_plain_search(d, k, kind, leaf):
    rng = np.random.default_rng(d * k)
    C = rng.normal(size=(k, d))
    X = rng.normal(size=(3000, d)) * 1.5
    if kind == "grid":
        C, X = np.round(C * 4) / 4, np.round(X * 8) / 8          # many ties and equal centres
    elif kind == "equal":
        C[:] = C[0]
    elif kind == "far":
        C, X = C + 1e6, X + 1e6
    X[5] = np.nan
    X[:3] = C[:3]
    a, d2, _ = nearest_two(X, C)
    b, e2, other = balls.CenterIndex(C, leaf).nearest_two(X)
    assert np.array_equal(a, b) and np.array_equal(d2, e2, equal_nan=True)
    full = ((X[:, None] - C[None]) ** 2).sum(-1)
    full[np.arange(len(X)), a] = np.inf
    ok = ~np.isnan(d2)
    assert (other[ok] <= full.min(1)[ok] * (1 + 1e-9) + 1e-9).all()


def test_few_centres_use_the_plain_search():
    C = np.zeros((3, 2))
    assert balls.searcher(C)(np.ones((2, 2)))[0].tolist() == [0, 0]


def test_assignment_of_a_table_goes_through_the_index(spark, monkeypatch):
    from pyspark.sql import functions as F
    from kmstream.functions.vectors import with_assignment
    rng = np.random.default_rng(3)
    C = np.round(rng.normal(size=(60, 2)), 1)
    rows = [*np.round(rng.normal(size=(300, 2)), 1).tolist(), [None, 1.0]]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, a double, b double")
    plain = with_assignment(df, [F.col("a"), F.col("b")], C.tolist()).orderBy("i").collect()
    monkeypatch.setattr(balls, "MANY", 2)
    assert with_assignment(df, [F.col("a"), F.col("b")], C.tolist()).orderBy("i").collect() == plain

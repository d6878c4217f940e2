"""E-1..E-6: statistics, z-score, unit scaling, PCA (fixture matrix)."""

import numpy as np
import pytest

from kmstream.operators.reduce import components_for_variance, fit_pca
from kmstream.operators.scale import UnitScale, ZScore, column_stats

# The 4 x 5 PCA test matrix.
PCA_MATRIX = [
    [1.0, 2.0, 3.0, 4.0, 18.0],
    [1.0, 2.0, 3.0, 5.0, 1.0],
    [1.0, 2.0, 5.0, 7.0, 4.0],
    [1.0, 4.0, 5.0, 2.0, 3.0],
]
COLS = [f"c{i}" for i in range(5)]


@pytest.fixture
def mat(spark):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(PCA_MATRIX)],
                                 "id long, " + ", ".join(f"{c} double" for c in COLS))


def test_zscore_population(spark):
    qty = [7500000.0, 21900000.0, 16000000.0, 12700000.0, 25000000.0,
           5000000.0, 15000000.0, 20000000.0, 30000000.0, 8800000.0]
    df = spark.createDataFrame([(q,) for q in qty], "q double")
    m = ZScore(["q"]).fit(df)
    assert m.means[0] == pytest.approx(np.mean(qty))
    assert m.sds[0] == pytest.approx(np.std(qty))
    z = [r[0] for r in m.transform(df).collect()]
    assert np.mean(z) == pytest.approx(0.0, abs=1e-12)
    assert np.std(z) == pytest.approx(1.0)


def test_zscore_constant_column_centres_only(mat):
    m = ZScore(["c0", "c1"]).fit(mat)
    rows = m.transform(mat).orderBy("id").collect()
    assert all(r["c0"] == 0.0 for r in rows)
    assert rows[3]["c1"] == pytest.approx((4.0 - 2.5) / np.std([2, 2, 2, 4]))


def test_zscore_independent_of_partitioning(mat):
    a = ZScore(COLS).fit(mat.repartition(1))
    b = ZScore(COLS).fit(mat.repartition(4))
    assert np.allclose(a.sds, b.sds) and np.allclose(a.means, b.means)


def test_unit_scale_fixture(mat):
    rows = UnitScale(COLS).fit(mat).transform(mat).orderBy("id").collect()
    r0 = [rows[0][c] for c in COLS]
    assert r0 == pytest.approx([0.0, 2.0, 2.5980762, 1.9215378, 2.3174], abs=1e-4)


def test_column_stats(mat):
    s = {r["column"]: r for r in column_stats(mat, ["c3"]).collect()}["c3"]
    x = np.array([4.0, 5.0, 7.0, 2.0])
    assert s["n"] == 4 and s["sum"] == x.sum() and s["sum_sq"] == (x * x).sum()
    assert s["sd_pop"] == pytest.approx(x.std()) and s["sd_samp"] == pytest.approx(x.std(ddof=1))


def test_pca_fixture(mat):
    res = fit_pca(mat, COLS, 3)
    assert res.explained_variance == pytest.approx([0.90691822, 0.07514882, 0.01793296], abs=1e-6)
    rows = mat.select("id", *res.project_exprs(COLS)).orderBy("id").collect()
    got = np.abs([[r["pc1"], r["pc2"], r["pc3"]] for r in rows])
    want = [[17.518315, 2.799269, 5.727373], [0.545636, 3.537832, 4.551495],
            [3.331450, 5.231367, 7.075614], [2.428518, 0.143072, 6.527780]]
    assert np.allclose(got, want, atol=1e-5)
    # sign rule: the largest-magnitude loading of each component is positive
    for j in range(3):
        col = res.components[:, j]
        assert col[np.argmax(np.abs(col))] > 0


def test_components_for_variance():
    assert components_for_variance([0.5, 0.3, 0.15, 0.05], 0.91) == 3
    assert components_for_variance([0.95, 0.05], 0.91) == 1

"""E-4..E-6: principal components.

``pyspark.ml.feature.PCA`` forms the d x d covariance from one distributed
pass (tree-aggregated Gramian) and projects rows without centring them, as
the reference does. Component signs are arbitrary in any eigen solver; we
fix them so that each component's largest-magnitude loading is positive.
The d x d matrix lives on the driver, so d must stay moderate.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class PCAResult:
    components: np.ndarray          # d x m, sign-fixed
    explained_variance: list[float]

    def project_exprs(self, cols: Sequence[str], prefix: str = "pc"):
        """Rows x components as unrolled column arithmetic (no centring)."""
        out = []
        for j in range(self.components.shape[1]):
            terms = [F.col(c).cast("double") * F.lit(float(self.components[i, j]))
                     for i, c in enumerate(cols)]
            e = terms[0]
            for t in terms[1:]:
                e = e + t
            out.append(e.alias(f"{prefix}{j + 1}"))
        return out


def _fix_signs(pc: np.ndarray) -> np.ndarray:
    pc = pc.copy()
    for j in range(pc.shape[1]):
        i = int(np.argmax(np.abs(pc[:, j])))
        if pc[i, j] < 0:
            pc[:, j] = -pc[:, j]
    return pc


def fit_pca(df: DataFrame, cols: Sequence[str] | None, m: int,
            features_col: str | None = None) -> PCAResult:
    """E-4: top-m components of plain columns or of a vector column."""
    if features_col is None:
        df = VectorAssembler(inputCols=list(cols), outputCol="_pca_in").transform(df)
        features_col = "_pca_in"
    model = PCA(k=m, inputCol=features_col, outputCol="_pca_out").fit(df)
    pc = model.pc.toArray()
    return PCAResult(_fix_signs(pc), [float(v) for v in model.explainedVariance.toArray()])


def project_vector(df: DataFrame, res: PCAResult, features_col: str,
                   output_col: str = "pca") -> DataFrame:
    """E-4 projection of a vector column (sparse ok) -> array<double>."""
    pc = res.components

    @F.pandas_udf("array<double>")
    def project(values: pd.Series, at: pd.Series) -> pd.Series:
        # the non-zero entries of each row times their loadings
        return pd.Series([np.asarray(v, dtype=np.float64) @ pc[np.asarray(i, dtype=np.int64)] if len(i) else np.zeros(pc.shape[1])
                          for v, i in zip(values, at)])

    arr = vector_to_array(F.col(features_col))
    at = F.filter(F.sequence(F.lit(0), F.size("_arr") - 1), lambda i: F.get(F.col("_arr"), i) != 0.0)
    rows = df.withColumn("_arr", arr).withColumn("_at", at)
    values = F.transform("_at", lambda i: F.get(F.col("_arr"), i))
    return rows.withColumn(output_col, project(values, F.col("_at"))).drop("_arr", "_at")


def components_for_variance(explained: Sequence[float], target: float = 0.91) -> int:
    """E-6: smallest m whose cumulative explained variance reaches ``target``."""
    acc = 0.0
    for i, v in enumerate(explained):
        acc += v
        if acc >= target - 1e-12:
            return i + 1
    return len(explained)

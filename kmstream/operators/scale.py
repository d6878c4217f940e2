"""E-1..E-3: column statistics, z-score and unit-variance scaling.

Each fit is ONE aggregation pass (partial aggregation on every task, one
row to the driver: 2 numbers per column); each transform is a projection
with literal constants, so it fuses into the consumer's codegen stage.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """E-1 / H-3..H-6 as a table: (column, n, sum, sum_sq, mean, sd_pop, sd_samp).

    A single grouped-less aggregation; the result has one row per column
    (built with ``stack`` from the single aggregate row, no second pass).
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.sum(x).alias(f"_s{i}"), F.sum(x * x).alias(f"_q{i}"),
                 F.avg(x).alias(f"_m{i}"), F.stddev_pop(x).alias(f"_p{i}"),
                 F.stddev_samp(x).alias(f"_v{i}")]
    one = df.agg(*aggs)
    parts = ", ".join(
        f"'{c}', _n, _s{i}, _q{i}, _m{i}, _p{i}, _v{i}" for i, c in enumerate(cols))
    return one.selectExpr(
        f"stack({len(cols)}, {parts}) as (column, n, sum, sum_sq, mean, sd_pop, sd_samp)")


@dataclass
class ZScoreModel:
    cols: list[str]
    means: list[float]
    sds: list[float]
    n: int = 0          # rows seen by the fit (same aggregation pass)

    def raw_exprs(self):
        """E-2: (x - mean) / sd; sd <= 0 -> centre only (unaliased)."""
        out = []
        for c, m, s in zip(self.cols, self.means, self.sds):
            x = F.col(c).cast("double")
            out.append((x - F.lit(m)) if s <= 0 else (x - F.lit(m)) / F.lit(s))
        return out

    def exprs(self, suffix: str = ""):
        return [e.alias(c + suffix) for c, e in zip(self.cols, self.raw_exprs())]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        if suffix:
            return df.select("*", *self.exprs(suffix))
        keep = [F.col(c) for c in df.columns if c not in self.cols]
        return df.select(*keep, *self.exprs())


class ZScore:
    """Population z-score (correct variant of D1; sd = sqrt(n*Sxx - Sx^2)/n)."""

    def __init__(self, cols: Sequence[str]):
        self.cols = list(cols)

    def fit(self, df: DataFrame) -> ZScoreModel:
        aggs = []
        for c in self.cols:
            x = F.col(c).cast("double")
            aggs += [F.avg(x), F.stddev_pop(x)]
        row = df.agg(*aggs, F.count(F.lit(1))).first()
        means = [float(row[2 * i] or 0.0) for i in range(len(self.cols))]
        sds = [float(row[2 * i + 1] or 0.0) for i in range(len(self.cols))]
        return ZScoreModel(self.cols, means, sds, int(row[-1]))


@dataclass
class UnitScaleModel:
    cols: list[str]
    sds: list[float]

    def raw_exprs(self):
        out = []
        for c, s in zip(self.cols, self.sds):
            x = F.col(c).cast("double")
            # constant column -> 0.0, as pyspark.ml.feature.StandardScaler does
            out.append(F.lit(0.0) if not s or s <= 0 else x / F.lit(s))
        return out

    def exprs(self, suffix: str = ""):
        return [e.alias(c + suffix) for c, e in zip(self.cols, self.raw_exprs())]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        if suffix:
            return df.select("*", *self.exprs(suffix))
        keep = [F.col(c) for c in df.columns if c not in self.cols]
        return df.select(*keep, *self.exprs())


class UnitScale:
    """E-3: divide by the sample sd, no centring."""

    def __init__(self, cols: Sequence[str]):
        self.cols = list(cols)

    def fit(self, df: DataFrame) -> UnitScaleModel:
        row = df.agg(*[F.stddev_samp(F.col(c).cast("double")) for c in self.cols]).first()
        return UnitScaleModel(self.cols, [float(v) if v is not None else 0.0 for v in row])


@dataclass
class RunningMoments:
    """Mergeable (n, mean, M2) per column, M2 the sum of squared distances to the mean.

    Nulls and NaN count nowhere. ``merge`` is exact for any split of the rows
    (Chan, Golub and LeVeque, 1979), so the moments follow a stream batch by batch.
    """

    cols: list[str]
    n: list[int]
    mean: list[float]
    m2: list[float]

    @classmethod
    def none(cls, cols: Sequence[str]) -> "RunningMoments":
        return cls(list(cols), [0] * len(cols), [0.0] * len(cols), [0.0] * len(cols))

    @classmethod
    def of(cls, df: DataFrame, cols: Sequence[str]) -> "RunningMoments":
        """One aggregation of a batch."""
        aggs = []
        for c in cols:
            x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
            aggs += [F.count(x), F.avg(x), F.var_pop(x)]
        row = df.agg(*aggs).first()
        n = [int(v) for v in row[0::3]]
        return cls(list(cols), n, [float(v or 0.0) for v in row[1::3]], [float(v or 0.0) * k for v, k in zip(row[2::3], n)])

    def merge(self, other: "RunningMoments") -> "RunningMoments":
        out = RunningMoments.none(self.cols)
        for i, (a, b) in enumerate(zip(self.n, other.n)):
            n = a + b
            if n:
                gap = other.mean[i] - self.mean[i]
                out.n[i], out.mean[i] = n, self.mean[i] + gap * b / n
                out.m2[i] = self.m2[i] + other.m2[i] + gap * gap * a * b / n
        return out

    def unit_scale(self) -> UnitScaleModel:
        """The unit scaling (sample deviation) of all rows merged so far."""
        return UnitScaleModel(self.cols, [(m / (n - 1)) ** 0.5 if n > 1 else 0.0 for n, m in zip(self.n, self.m2)])

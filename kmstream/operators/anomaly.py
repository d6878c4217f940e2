"""F-20..F-22: distance-threshold anomaly detection.

The threshold is the N-th largest distance to the own centre. It is found
with a top-N (TakeOrderedAndProject: every task keeps N candidates, one
task merges partitions x N), so no full sort and no unbounded collect.
The detector flags rows strictly above the threshold (at most N-1 rows).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kmstream.functions.stats import k_rule_of_thumb
from kmstream.functions.vectors import with_assignment
from kmstream.operators.cluster import (assemble, first_rows_init, fit_kmeans, lloyd,
                                        mean_centers)
from kmstream.operators.scale import ZScore, ZScoreModel


def topn_threshold(df: DataFrame, dist_col: str, n: int) -> float | None:
    """F-20 / H-9: N-th largest value (the smallest one when fewer rows)."""
    top = df.select(dist_col).orderBy(F.desc(dist_col)).limit(n).collect()
    return float(top[-1][0]) if top else None


@dataclass
class AnomalyModel:
    zscore: ZScoreModel | None
    centers: list[list[float]]
    threshold: float | None
    cols: list[str]

    def transform(self, df: DataFrame, dist_col: str = "dist",
                  flag_col: str = "is_anomaly", cluster_col: str = "cluster") -> DataFrame:
        """Adds cluster, distance to own centre and the anomaly flag."""
        if self.zscore is not None:
            scaled = self.zscore.raw_exprs()
        else:
            scaled = [F.col(c).cast("double") for c in self.cols]
        out = with_assignment(df, scaled, self.centers, cluster_col, dist_col)
        thr = F.lit(self.threshold) if self.threshold is not None else F.lit(None).cast("double")
        return out.withColumn(flag_col, F.coalesce(F.col(dist_col) > thr, F.lit(False)))


class AnomalyDetector:
    """F-21: (z-score) -> k-means -> N-th largest distance -> strict ``>``.

    ``init="fixed"`` runs Lloyd from the first k rows by ``order_by`` (exact
    and reproducible); ``init="k-means||"`` runs ``runs`` restarts with
    k-means|| starts, all sharing each scan; ``init="ml"`` uses
    ``pyspark.ml.clustering.KMeans`` for every restart. ``k=None`` takes the rule of thumb as it is.
    Rows with a null or NaN feature are neither trained on nor flagged.
    """

    def __init__(self, cols: Sequence[str], k: int | None = None, n_top: int = 100,
                 normalize: bool = True, init: str = "fixed", order_by: str | None = None,
                 max_iter: int = 20, tol: float = 1e-6, runs: int = 10, seed: int = 1):
        self.cols, self.k, self.n_top = list(cols), k, n_top
        self.normalize, self.init, self.order_by = normalize, init, order_by
        self.max_iter, self.tol, self.runs, self.seed = max_iter, tol, runs, seed

    def fit(self, df: DataFrame) -> AnomalyModel:
        zs = ZScore(self.cols).fit(df) if self.normalize else None
        scaled = zs.transform(df) if zs else df.select(
            *[F.col(c).cast("double").alias(c) for c in self.cols],
            *([self.order_by] if self.order_by else []))
        k = self.k
        if k is None:
            n = zs.n if zs is not None else df.count()     # z-score pass already counted
            k = max(1, k_rule_of_thumb(n))
        if k == 1:
            centers = mean_centers(scaled, self.cols)
        elif self.init == "fixed":
            if not self.order_by:
                raise ValueError("init='fixed' needs order_by (a unique key)")
            starts = first_rows_init(scaled, self.cols, self.order_by, k)
            centers = lloyd(scaled, self.cols, {k: starts}, self.max_iter, self.tol,
                            score=False)[k].centers
        elif self.init == "ml":
            feats = assemble(scaled, self.cols, "_features").cache()
            try:
                centers = fit_kmeans(feats, k, "_features", self.runs, self.tol,
                                     self.max_iter, self.seed).centers
            finally:
                feats.unpersist()
        else:
            from kmstream.operators.restarts import fit_restarts
            centers = fit_restarts(scaled, self.cols, [k], self.runs, self.tol,
                                   self.max_iter, self.seed)[k].centers
        model = AnomalyModel(zs, centers, None, self.cols)
        scored = model.transform(df).filter(F.col("dist").isNotNull())
        model.threshold = topn_threshold(scored, "dist", self.n_top)
        return model


def grouped_anomalies(df: DataFrame, group_col: str, id_col: str, cols: Sequence[str], k: int,
                      n_top: int, max_iter: int = 20, keep: Sequence[str] = ()) -> DataFrame:
    """F-21 with one independent model per group (e.g. per micro-batch key).

    Per group: population z-score, fixed-start Lloyd, N-th largest distance,
    rows strictly above it. All groups are fitted together: every step is a
    grouped aggregation or a join against a table of groups x k rows, and the
    per-group top-N uses ``row_number() <= N`` (pre-limited per task).
    """
    from pyspark.sql import Window

    from kmstream.functions.vectors import complete
    from kmstream.operators.cluster import grouped_assign, grouped_lloyd
    from kmstream.session import drop_stored, stored
    spark = df.sparkSession
    df = df.filter(complete([F.col(c).cast("double") for c in cols]) & F.col(group_col).isNotNull())
    stats = df.groupBy(group_col).agg(*[a for c in cols for a in (
        F.avg(F.col(c).cast("double")).alias(f"_m_{c}"),
        F.stddev_pop(F.col(c).cast("double")).alias(f"_s_{c}"))])
    extra = [c for c in keep if c not in (group_col, id_col)]
    z = df.join(stats, group_col).select(
        group_col, id_col, *extra,
        *[F.when(F.col(f"_s_{c}") <= 0, F.col(c).cast("double") - F.col(f"_m_{c}"))
          .otherwise((F.col(c).cast("double") - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).alias(c)
          for c in cols])
    # read by every update and by the scoring: written once
    z, z_at = stored(spark, z, "group-scaled")
    centers = grouped_lloyd(z, group_col, id_col, cols, k, max_iter)
    # read twice below: for the threshold and for the rows above it
    scored, _ = stored(spark, grouped_assign(z, group_col, cols, centers, keep=[id_col, *extra]), "group-scored")
    drop_stored(spark, z_at)
    w = Window.partitionBy(group_col).orderBy(F.desc("dist"))
    thr = (scored.select(group_col, "dist").withColumn("_r", F.row_number().over(w))
           .where(F.col("_r") <= n_top).groupBy(group_col).agg(F.min("dist").alias("_thr")))
    return scored.join(thr, group_col).where(F.col("dist") > F.col("_thr")).drop("_thr")

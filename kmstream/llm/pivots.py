"""Embedding near-duplicates by a pivot-permutation index.

A vector is described by the ordered list of its ``nearest`` reference points
(pivots). Inverted lists, one per pivot, hold the vectors that name it; two
vectors of a list are candidates if they share at least ``shared`` pivots, and
candidates are verified by their cosine in double precision.

Pivots are a bounded sample: ``4 * pivots`` rows in the order of a hash of the
vector, thinned so that no two are closer than ``spread``; their number grows
with the square root of the number of different vectors (``per_root`` times,
between ``least`` and ``most``). Every length has pivots, and so lists, of its
own; lengths are taken to be few. Every vector is indexed.

Scale: equal vectors are one row from the start. A list is cut into chunks of
about ``block`` rows, and each pair of chunks is one group, so a pivot that a
third of all vectors name is many groups of bounded size. Groups return one
row per vector -- its number of links counted here, and the smallest member of
its local component -- never pairs: a pair that shares several pivots is
counted in the list of the smallest of them only. Sums and components are then
Spark aggregations and joins.

Recall: measured in ``tests/llm`` and the README against all pairs; a pair is
lost if the two share fewer than ``shared`` of their nearest pivots.

Defined results: null, zero or empty vectors and vectors with null or non-finite
components link with nothing; vectors link with others of their length; equal
vectors link with each other; repeated ids are rows of their own; the
component of rows without id is the smallest id among its members; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kmstream.llm.common import stored
from kmstream.llm.graph import connected_components


@dataclass(frozen=True)
class PivotRules:
    cosine: float = 0.9
    nearest: int = 8
    shared: int = 2
    per_root: float = 2.0
    least: int = 64
    most: int = 8192
    spread: float = 0.7   # largest cosine of two pivots
    block: int = 512


def _unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def choose_pivots(sample: np.ndarray, count: int, spread: float) -> np.ndarray:
    """Up to ``count`` rows, in order, none closer to an earlier one than ``spread``."""
    x, out = _unit(sample), []
    closest = np.full(len(x), -1.0)
    for i in range(len(x)):
        if closest[i] <= spread:
            out.append(i)
            if len(out) == count:
                break
            closest = np.maximum(closest, x @ x[i])
    return x[out]


def _local_components(linked: np.ndarray) -> np.ndarray:
    """The smallest index of each row's component under a symmetric boolean matrix."""
    label = np.arange(len(linked))
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], len(linked)).min(axis=1))
        low = np.minimum(low, low[low])
        if (low == label).all():
            return label
        label = low


def _compare(pdf: pd.DataFrame, rules: PivotRules) -> pd.DataFrame:
    """One group: a chunk against itself or two chunks of one pivot's list."""
    pivot, i, j = int(pdf["pivot"].iloc[0]), int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
    node, times = pdf["node"].to_numpy(np.int64), pdf["times"].to_numpy(np.int64)
    x = _unit(np.stack(pdf["v"].to_numpy()))
    named = np.stack(pdf["pivots"].to_numpy()).astype(np.int64)
    ids, place = np.unique(named, return_inverse=True)
    has = np.zeros((len(x), len(ids)), np.float32)
    has[np.arange(len(x))[:, None], place.reshape(named.shape)] = 1
    common = has @ has.T
    near = (common >= min(rules.shared, named.shape[1])) & (x @ x.T >= rules.cosine)
    near &= near.T
    np.fill_diagonal(near, False)
    if i != j:
        side = pdf["chunk"].to_numpy() == i
        near &= side[:, None] != side[None, :]
    a, b = np.nonzero(near)
    # the smallest pivot that both name
    both = (has[a] > 0) & (has[b] > 0)
    here = ids[both.argmax(axis=1)] == pivot if len(a) else np.empty(0, bool)
    n = np.bincount(a[here], weights=times[b[here]], minlength=len(x)).astype(np.int64)
    low = node[_local_components(near)] if len(a) else node
    out = pd.DataFrame({"node": node, "n": n, "low": low})
    return out[(out["n"] > 0) | (out["low"] != out["node"])]


def embedding_duplicates(spark: SparkSession, rows: DataFrame, rules: PivotRules = PivotRules(), vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row."""
    v = F.col("v")
    given = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    given = given.withColumns({"f1": F.xxhash64(F.lit(1), v), "f2": F.xxhash64(F.lit(2), v), "size": F.coalesce(F.size(v), F.lit(-1))})
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = F.coalesce((F.size(v) > 0) & ~odd & F.exists(v, lambda c: c != 0), F.lit(False))
    given = given.withColumn("ok", usable)
    good = F.col("ok")

    classes = (given.filter(good).groupBy("f1", "f2").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("times"), F.first("v").alias("v"),
                                                          F.first("size").alias("size"))
               .withColumn("node", F.monotonically_increasing_id()))
    classes = stored(spark, classes, "pivot-classes")
    pivots, first = {}, 0   # by length: (number of the first, pivots)
    for size, n in sorted(classes.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()):
        count = int(min(rules.most, max(rules.least, math.ceil(rules.per_root * math.sqrt(n)))))
        sample = classes.filter(F.col("size") == size).orderBy("f1", "f2").limit(4 * count).select("v").toPandas()["v"]
        pivots[size] = (first, choose_pivots(np.stack(sample.to_numpy()), count, rules.spread))
        first += len(pivots[size][1])
    shared = spark.sparkContext.broadcast(pivots)  # at most ``most`` vectors of a length

    def describe(batches):
        for pdf in batches:
            for size, rows in pdf.groupby(pdf["v"].str.len(), sort=False):
                start, p = shared.value[size]
                m = min(rules.nearest, len(p))
                for at in range(0, len(rows), 2048):
                    part = rows.iloc[at:at + 2048]
                    sims = _unit(np.stack(part["v"].to_numpy())) @ p.T
                    top = np.argpartition(-sims, m - 1, axis=1)[:, :m]
                    order = np.take_along_axis(-sims, top, 1).argsort(axis=1, kind="stable")
                    yield part.assign(pivots=list((start + np.take_along_axis(top, order, 1)).astype(np.int32)))

    kind = classes.schema["v"].dataType.simpleString()
    index = classes.select("node", "times", "v").mapInPandas(describe, f"node long, times long, v {kind}, pivots array<int>")
    index = stored(spark, index, "pivot-index")
    lists = index.select(F.explode("pivots").alias("pivot")).groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / rules.block).cast("int").alias("chunks"))
    named = index.withColumn("pivot", F.explode("pivots")).join(F.broadcast(lists), "pivot")  # a row per pivot
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    spread = (named.withColumn("chunk", chunk).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .select("pivot", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "node", "times", "v", "pivots"))
    met = spread.groupBy("pivot", "i", "j").applyInPandas(lambda pdf: _compare(pdf, rules), "node long, n long, low long")
    met = stored(spark, met, "pivot-links")

    links = met.groupBy("node").agg(F.sum("n").alias("n"))
    comps = connected_components(spark, met.select(F.col("node").alias("a"), F.col("low").alias("b")))
    known = classes.select("node", "f1", "f2", "times", "vec_id").join(links, "node", "left").join(comps, "node", "left")
    known = stored(spark, known.select("f1", "f2", "vec_id", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"),
                                       F.coalesce("component", "node").alias("component")), "pivot-known")
    least = known.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    named = known.join(least, "component").select("f1", "f2", "n_links", "component_id")
    linked = given.filter(good).select("vec_id", "f1", "f2").join(named, ["f1", "f2"]).select("vec_id", "n_links", "component_id")
    alone = given.filter(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

"""C-8 / D-2 with the label encoded, and k-means on (row, slot, value) entries.

With ``include_label`` the near-unique label is a one-hot column as well, so the
width grows with the table and no dense row or centre fits anywhere. Rows stay
entries: numerics first, then one slot per category, column by column; only values
other than 0 are there. Distances come from norms and sparse products,
|x - c|^2 = |x|^2 - 2 x.c + |c|^2, and the products from one join of the entries with
the centres' entries by slot, summed by row and centre.

Scale: the work is the entries that a row shares with a centre; a slot has at most k
centre entries, and Spark broadcasts or shuffles them by size. A category that a third
of all rows hold is a skewed join key of entries against k rows, which adaptive
execution splits. New centres are partial sums by (cluster, slot). The driver holds k
norms and sizes.

Rows with a null or NaN number are left out; a null category is a category (D-1).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kmstream.functions.vectors import complete
from kmstream.operators.encode import CategoryEncoder, CategoryModel
from kmstream.session import drop_stored, stored


@dataclass
class SparseRows:
    """``entries`` (id, slot, value), ``norms`` (id, norm2), the width of a row and the dictionary behind the slots."""

    entries: DataFrame
    norms: DataFrame
    width: int
    model: CategoryModel


def sparse_rows(df: DataFrame, id_col: str, numeric: Sequence[str], categorical: Sequence[str], label: str | None = None,
                include_label: bool = False, model: CategoryModel | None = None) -> SparseRows:
    """The rows of ``df`` (unique ``id_col``) as entries; ``include_label`` encodes the label behind the other categories."""
    if include_label and label is None:
        raise ValueError("include_label needs a label column")
    spark = df.sparkSession
    cats = [*categorical, *([label] if include_label else [])]
    df = df.filter(complete([F.col(c).cast("double") for c in numeric])) if numeric else df
    model = model or CategoryEncoder(cats).fit(df)
    base, offset = len(numeric), {}
    for c in cats:
        offset[c] = base
        base += model.sizes[c]
    numbers = [F.struct(F.lit(i).cast("long").alias("slot"), F.col(c).cast("double").alias("value")) for i, c in enumerate(numeric)]
    names = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category"), F.lit(offset[c]).cast("long").alias("first")) for c in cats]
    rows = df.select(F.col(id_col).alias("id"), *([F.array(*numbers).alias("numbers")] if numbers else []), *([F.array(*names).alias("names")] if names else []))
    parts = []
    if numbers:
        parts.append(rows.select("id", F.explode("numbers").alias("e")).select("id", "e.slot", "e.value").filter("value <> 0"))
    if names:
        held = rows.select("id", F.explode("names").alias("e")).select("id", "e.column", "e.category", "e.first")
        d = model.dictionary.select(F.col("column").alias("_c"), F.col("category").alias("_v"), "idx")
        met = held.join(d, (F.col("column") == F.col("_c")) & F.col("category").eqNullSafe(F.col("_v")))
        parts.append(met.select("id", (F.col("first") + F.col("idx")).alias("slot"), F.lit(1.0).alias("value")))
    entries = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    entries, _ = stored(spark, entries, "sparse-entries")
    norms = rows.select("id").join(entries.groupBy("id").agg(F.sum(F.col("value") * F.col("value")).alias("norm2")), "id", "left").na.fill(0.0, ["norm2"])
    norms, _ = stored(spark, norms, "sparse-norms")
    return SparseRows(entries, norms, base, model)


def sparse_starts(rows: SparseRows, k: int) -> DataFrame:
    """(cluster, slot, value) of the first k rows by id."""
    first = [r["id"] for r in rows.norms.orderBy("id").limit(k).collect()]
    place = F.element_at(F.create_map(*[x for i, v in enumerate(first) for x in (F.lit(v), F.lit(i).cast("long"))]), F.col("id"))
    return rows.entries.filter(F.col("id").isin(first)).select(place.alias("cluster"), "slot", "value")


def sparse_assign(rows: SparseRows, centers: DataFrame, k: int) -> DataFrame:
    """(id, cluster, d2): the nearest of k centres (cluster, slot, value), ties to the lowest id."""
    norms = {r["cluster"]: float(r["n"]) for r in centers.groupBy("cluster").agg(F.sum(F.col("value") * F.col("value")).alias("n")).collect()}
    products = (rows.entries.join(centers.select("cluster", "slot", F.col("value").alias("c")), "slot")
                .groupBy("id", "cluster").agg(F.sum(F.col("value") * F.col("c")).alias("dot")))
    dots = products.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("cluster", "dot"))).alias("dots"))   # at most k a row
    own = F.array(*[F.struct(F.lit(norms.get(j, 0.0)).alias("n"), F.lit(j).cast("long").alias("cluster")) for j in range(k)])
    met = rows.norms.join(dots, "id", "left")
    dot = lambda c: F.coalesce(F.try_element_at(F.col("dots"), c["cluster"]), F.lit(0.0))
    near = F.array_min(F.transform(own, lambda c: F.struct((F.col("norm2") - 2 * dot(c) + c["n"]).alias("d2"), c["cluster"].alias("cluster"))))
    return met.select("id", near.alias("near")).select("id", "near.cluster", F.greatest(F.col("near.d2"), F.lit(0.0)).alias("d2"))


def sparse_lloyd(rows: SparseRows, k: int, updates: int = 20, tol: float = 1e-6) -> DataFrame:
    """(cluster, slot, value) after Lloyd updates from the first k rows; an empty cluster keeps its centre."""
    spark = rows.entries.sparkSession
    centers, place = stored(spark, sparse_starts(rows, k), "sparse-centers")
    for _ in range(updates):
        near, at = stored(spark, sparse_assign(rows, centers, k), "sparse-near")
        sizes = near.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
        sums = rows.entries.join(near.select("id", "cluster"), "id").groupBy("cluster", "slot").agg(F.sum("value").alias("s"))
        means = sums.join(sizes, "cluster").select("cluster", "slot", (F.col("s") / F.col("n")).alias("value"))
        kept = centers.join(sizes.select("cluster"), "cluster", "left_anti").select("cluster", "slot", "value")
        new, now = stored(spark, means.unionByName(kept), "sparse-centers")
        gap = F.coalesce("value", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))
        both = new.join(centers.withColumnRenamed("value", "old"), ["cluster", "slot"], "full").withColumn("g", gap * gap)
        moved = both.groupBy("cluster").agg(F.sum("g").alias("g")).agg(F.max("g")).first()[0]
        for old in (place, at):
            drop_stored(spark, old)
        centers, place = new, now
        if moved is None or moved <= tol * tol:
            break
    return centers

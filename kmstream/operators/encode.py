"""D-1..D-4: category dictionaries and one-hot encoding.

The dictionary ``(column, category, idx)`` gives each distinct value of a
column its 0-based alphabetical index (decision D3: deterministic, unlike
the reference's shuffle order). It is built without a single-task window:
distinct pairs are range-partitioned, each partition numbers its sorted
rows, and per-partition offsets come from a table of (partition, column)
counts whose size is bounded by partitions + columns. The tagged pairs are
reliably checkpointed so that ids and offsets refer to the same rows even
if a task is recomputed.

A null value is a category of its own (it sorts first), as the empty string is.

The dictionary is attached to the data by one null-safe join per column; Spark
broadcasts a column's part while it is under its size limit and otherwise
shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kmstream.session import ensure_checkpoint_dir


def category_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """H-2: distinct (column, category) pairs in one pass (partial aggregation)."""
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, category string")
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category"))
               for c in cols]
    return (df.select(F.explode(F.array(*entries)).alias("_p"))
            .select("_p.column", "_p.category").distinct())


def category_dictionary(df: DataFrame, cols: Sequence[str],
                        partitions: int | None = None) -> DataFrame:
    """D-1: (column STRING, category STRING, idx BIGINT), alphabetical per column."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    pairs = category_pairs(df, cols)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (pairs.repartitionByRange(n, "column", "category")
              .sortWithinPartitions("column", "category")
              .select("column", "category",
                      F.spark_partition_id().alias("_pid"),
                      F.monotonically_increasing_id().alias("_mid"))
              .checkpoint(eager=True))
    # (partition, column) -> first id and count; small: <= partitions + columns rows
    blocks = tagged.groupBy("_pid", "column").agg(F.min("_mid").alias("_first"),
                                                  F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy("column").orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    return (tagged.join(F.broadcast(offsets.select("_pid", "column", "_first", "_off")),
                        ["_pid", "column"])
            .select("column", "category",
                    (F.col("_off") + F.col("_mid") - F.col("_first")).cast("long").alias("idx")))


@dataclass
class CategoryModel:
    cols: list[str]
    dictionary: DataFrame
    sizes: dict[str, int]

    def index(self, df: DataFrame, suffix: str = "_idx", handle_invalid: str = "error"
              ) -> DataFrame:
        """D-4: attach ``<col>_idx``; unseen values raise (or get ``size`` with 'keep')."""
        out = df
        for c in self.cols:
            d = self.dictionary.where(F.col("column") == c).select(
                F.col("category").alias(f"_cat_{c}"), F.col("idx").alias(c + suffix))
            out = out.join(d, F.col(c).cast("string").eqNullSafe(F.col(f"_cat_{c}")), "left") \
                .drop(f"_cat_{c}")
            miss = F.col(c + suffix).isNull()
            if handle_invalid == "keep":
                fill = F.lit(self.sizes[c]).cast("long")
            else:
                fill = F.raise_error(F.concat(F.lit(f"unseen category in {c}: "),
                                              F.coalesce(F.col(c).cast("string"), F.lit("null"))))
            # nominal-attribute metadata carries the category count, so a downstream
            # OneHotEncoder.fit reads the size from the schema instead of scanning
            meta = {"ml_attr": {"type": "nominal", "num_vals": int(self.sizes[c]),
                                "name": c + suffix}}
            out = out.withColumn(c + suffix, F.when(miss, fill).otherwise(F.col(c + suffix))
                                 .cast("double").alias(c + suffix, metadata=meta))
        return out

    def one_hot(self, df: DataFrame, suffix: str = "_vec", handle_invalid: str = "error"
                ) -> DataFrame:
        """D-2: one sparse block per column, one slot per category, none dropped."""
        idx = self.index(df, "_idx", handle_invalid)
        if not self.cols:
            return idx
        enc = OneHotEncoder(inputCols=[c + "_idx" for c in self.cols],
                            outputCols=[c + suffix for c in self.cols], dropLast=False,
                            handleInvalid="keep" if handle_invalid == "keep" else "error")
        return enc.fit(idx).transform(idx)


class CategoryEncoder:
    def __init__(self, cols: Sequence[str]):
        self.cols = list(cols)

    def fit(self, df: DataFrame) -> CategoryModel:
        d = category_dictionary(df, self.cols).checkpoint(eager=True)
        sizes = {r["column"]: int(r["n"]) for r in
                 d.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
        return CategoryModel(self.cols, d, {c: sizes.get(c, 0) for c in self.cols})


def encode_features(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                    output_col: str = "features", model: CategoryModel | None = None,
                    label: str | None = None, include_label: bool = False) -> tuple[DataFrame, CategoryModel]:
    """D-3 / C-8: numerics, then one-hot blocks in schema order, as one (sparse) vector.

    ``include_label`` encodes the label as the last block (D4); its width grows with the
    table, so fits on such rows go through ``operators.sparse``.
    """
    if include_label:
        if label is None:
            raise ValueError("include_label needs a label column")
        categorical = [*categorical, label]
    model = model or CategoryEncoder(categorical).fit(df)
    enc = model.one_hot(df)
    vec = VectorAssembler(inputCols=list(numeric) + [c + "_vec" for c in categorical],
                          outputCol=output_col).transform(enc)
    return vec, model

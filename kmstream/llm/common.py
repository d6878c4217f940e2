"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kmstream.session import scratch_dir

#: Fixed value: what counts as a word (anything between ASCII white space).
WORD = r"[^\x20\x09-\x0D]+"

SYMBOLS = "#*$%&|<>"


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: what follows reads a table that survives the loss of any
    executor, and later passes read only the columns they need.
    """
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, columns: list[str]) -> str:
    """``name``, or the first of name_1, name_2, ... that no given column has (case ignored)."""
    taken = {c.lower() for c in columns}
    out, k = name, 0
    while out.lower() in taken:
        k += 1
        out = f"{name}_{k}"
    return out


def text_blocks(pdf: pd.DataFrame, column: str, limit: int = 4 << 20):
    """Row slices of a batch whose text adds up to about ``limit`` characters."""
    sizes = pdf[column].str.len().fillna(0).to_numpy()
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield pdf.iloc[start:i]
            start, total = i, 0
        total += n
    if start < len(pdf):
        yield pdf.iloc[start:]


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows of the Arrow batches that later steps send to Python workers.

    The session's default suits numbers; ten thousand long texts with their
    copies as Python strings would take hundreds of MB of each worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def numbered(spark: SparkSession, df: DataFrame, order: list, name: str, column: str = "m") -> DataFrame:
    """``df`` sorted over all partitions and stored, with a number that ascends in that order.

    Rows are range-partitioned by ``order`` and a last tie-breaker, so equal rows, however many,
    spread over partitions too. The number's upper bits (from bit 33) name the partition; inside
    one it counts without gaps.
    """
    tie = fresh("tie", df.columns)
    rows = df.withColumn(tie, F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order, F.col(tie)).sortWithinPartitions(*order, F.col(tie)).drop(tie)
    return stored(spark, rows.withColumn(column, F.monotonically_increasing_id()), name)


def ranked(spark: SparkSession, df: DataFrame, by: str, order: list, name: str) -> DataFrame:
    """``df`` with ``idx`` (0, 1, ... in ``order`` among the rows of equal ``by``, never null) and ``n`` (how many there are).

    The rows of a key are counted by partition; the table of these counts has one row per key and
    partition that holds it, and only it meets a window.
    """
    rows = numbered(spark, df, [F.col(by), *order], name)
    parts = rows.groupBy(F.col(by), F.shiftright("m", 33).alias("pid")).agg(F.min("m").alias("lo"), F.count(F.lit(1)).alias("k"))
    whole = W.partitionBy(by)
    before = whole.orderBy("pid").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(by, "pid", "lo", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("first"), F.sum("k").over(whole).alias("n"))
    met = rows.withColumn("pid", F.shiftright("m", 33)).join(parts, [by, "pid"])
    return met.withColumn("idx", F.col("m") - F.col("lo") + F.col("first")).drop("pid", "m", "lo", "first")

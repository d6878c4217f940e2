"""Table, text and console sinks.

B-1 (appending lines to a local file) becomes a table write by the
executors: Parquet partitioned by a run or batch column, written with
dynamic partition overwrite so that a retried batch replaces its own
partition instead of appending a second copy.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def withdraw(spark: SparkSession, out: str, epoch: int) -> None:
    """Take back an epoch's commit before its tables are written (again)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{out}/commits/epoch={epoch}")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def commit(spark: SparkSession, out: str, epoch: int, tables: Sequence[str]) -> None:
    """The epoch's manifest, written when all its tables are: their names and the time."""
    row = spark.createDataFrame([(epoch, list(tables))], "epoch long, tables array<string>")
    write_table(row.withColumn("committed_at", F.current_timestamp()), f"{out}/commits", ["epoch"])


def committed(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The rows of one of a job's tables that belong to committed epochs.

    All tables of an epoch become visible with its manifest, together; an epoch that
    was cut short, or is being written again, is not seen in any of them.
    """
    done = spark.read.parquet(f"{out}/commits").select(F.col("epoch").cast("long").alias("epoch"), F.explode("tables").alias("_table"))
    epochs = done.filter(F.col("_table") == name).select("epoch")
    rows = spark.read.parquet(f"{out}/{name}")
    return rows.withColumn("epoch", F.col("epoch").cast("long")).join(epochs, "epoch", "left_semi")


def write_text(df: DataFrame, col: str, path: str, mode: str = "overwrite") -> None:
    """One line per row (B-4 / B-5 text form)."""
    df.select(F.col(col).cast("string").alias("value")).write.mode(mode).text(path)


def centers_text(centers: DataFrame, center_col: str = "center") -> DataFrame:
    """B-2: one comma-separated line per centre."""
    return centers.select("*", F.array_join(F.col(center_col).cast("array<string>"), ",")
                          .alias("line"))


def console(stream: DataFrame, rows: int = 20, trigger: str | None = None,
            available_now: bool = False, checkpoint: str | None = None):
    """B-7: print the first rows of every micro-batch on the driver console."""
    w = stream.writeStream.format("console").option("numRows", rows).option("truncate", False)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q

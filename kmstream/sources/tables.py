"""Batch table sources (Parquet test tables and plain text files)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; column pruning and filters reach the Parquet scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """A-1: one record per line, column ``value``."""
    return spark.read.text(path)

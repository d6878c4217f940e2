"""A-2..A-5: streaming sources.

* directory of text (or Parquet) files -> ``readStream``; rate cap with
  ``maxFilesPerTrigger`` (A-5),
* Kafka topics -> ``readStream.format("kafka")``; the value is decoded to a
  string line and the key is ignored. The Kafka connector jar is not part of
  every installation; :func:`read_kafka` raises a clear error when it is
  missing, and everything below it is tested on file streams and on static
  ``(key, value)`` frames.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None
                     ) -> DataFrame:
    """A-2: new text files in a directory; one row per line, column ``value``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def read_parquet_stream(spark: SparkSession, path: str, schema: StructType,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """A-2 for columnar files (schema given, no inference on a stream)."""
    r = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def read_kafka(spark: SparkSession, brokers: str | Sequence[str], topics: str | Sequence[str],
               max_offsets_per_trigger: int | None = None, starting_offsets: str = "latest"
               ) -> DataFrame:
    """A-3: subscribe to topics on several brokers; returns decoded lines."""
    if not isinstance(brokers, str):
        brokers = ",".join(brokers)
    if not isinstance(topics, str):
        topics = ",".join(topics)
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", brokers)
         .option("subscribe", topics)
         .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    try:
        raw = r.load()
    except Exception as e:  # connector jar absent
        raise RuntimeError("Kafka source unavailable: add the spark-sql-kafka package "
                           "to the session (spark.jars.packages)") from e
    return decode_kafka_value(raw)


def decode_kafka_value(raw: DataFrame) -> DataFrame:
    """Kafka ``(key, value)`` binary pair -> ``value`` string line (key dropped)."""
    return raw.select(F.col("value").cast("string").alias("value"))

"""Keyed top-N state: the thresholds of the whole history after every batch, over restarts."""

import pytest
from pyspark.sql import functions as F

from kmstream.session import scratch_dir
from kmstream.sources.streams import read_parquet_stream
from kmstream.streaming.topn import run_topn


def test_thresholds_follow_the_history(spark):
    kind = "key string, value double"
    batches = [[("hot", float(i * 7 % 101)) for i in range(300)] + [("few", 3.0), (None, 1.0), ("few", None), ("nan", float("nan"))],
               [("few", 5.0), ("few", 5.0), ("few", 4.0)],
               [("hot", 500.0), ("hot", 100.0), (None, 9.0), ("new", 2.0)]]
    src, out = scratch_dir(spark, "t-topn"), scratch_dir(spark, "t-topn-out")
    seen, want = [], set()
    for epoch, rows in enumerate(batches):
        spark.createDataFrame(rows, kind).repartition(3).write.mode("append").parquet(src)
        stream = read_parquet_stream(spark, src, spark.createDataFrame([], kind).schema)
        run_topn(stream, F.col("key"), F.col("value"), 3, out, out + "_checkpoint")     # a query of its own each time: a restart
        good = [(k, v) for k, v in rows if v is not None and v == v]
        seen += good
        for key in {k for k, _ in good}:
            top = sorted((v for k, v in seen if k == key), reverse=True)
            want.add((epoch, key, len(top), top[:3][-1], sum(v > top[:3][-1] for v in top[:3])))
    got = {(r["epoch"], r["key"], r["seen"], r["threshold"], r["above"]) for r in spark.read.parquet(out).collect()}
    assert got == want


@pytest.mark.parametrize("n", [1, 5])
def test_empty_stream_writes_nothing(spark, n):
    kind = "key string, value double"
    src, out = scratch_dir(spark, "t-topn"), scratch_dir(spark, "t-topn-out")
    spark.createDataFrame([("a", None)], kind).write.parquet(src)
    run_topn(read_parquet_stream(spark, src, spark.createDataFrame([], kind).schema), F.col("key"), F.col("value"), n, out, out + "_checkpoint")
    assert spark.read.schema("key string").parquet(out).count() == 0

"""F-20 across batches: the N-th largest distance per key as keyed state.

The state of a key is a bounded heap, its N largest values so far, and the number of
rows seen. Heaps merge: a batch is first reduced to N values per key in every task
(a key with a third of all rows ships N values a task), and the state takes those of
all tasks. So the threshold follows the stream without a refit and without reading
history. State lives in the stream's checkpoint; a restarted query goes on from it.

Rows without a value count nowhere; a null key is a key of its own; a key is emitted
in the batches that hold rows of it; with fewer than N rows the threshold is the
smallest value, as in :func:`operators.anomaly.topn_threshold`.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kmstream.sinks.tables import write_table

OUT = "key string, seen long, threshold double, above long"


def running_topn(stream: DataFrame, key: Column, value: Column, n: int) -> DataFrame:
    """(key, seen, threshold, above) per key of every micro-batch; ``above`` counts the held values over the threshold."""

    def largest(batches):
        for pdf in batches:
            held = pdf.sort_values("value", ascending=False).groupby("key", dropna=False, sort=False)
            top = held.head(n)
            size = held["value"].transform("size").loc[top.index]
            first = ~top["key"].duplicated()
            yield top.assign(rows=size.where(first, 0).astype("int64"))

    def follow(key, pdfs, state: GroupState):
        top, seen = (list(state.get[0]), int(state.get[1])) if state.exists else ([], 0)
        for pdf in pdfs:
            top = heapq.nlargest(n, top + pdf["value"].tolist())
            seen += int(pdf["rows"].sum())
        state.update((top, seen))
        yield pd.DataFrame({"key": [key[0]], "seen": [seen], "threshold": [top[-1]], "above": [sum(v > top[-1] for v in top)]})

    rows = stream.select(key.cast("string").alias("key"), value.cast("double").alias("value"))
    rows = rows.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    reduced = rows.mapInPandas(largest, "key string, value double, rows long")
    return reduced.groupBy("key").applyInPandasWithState(follow, OUT, "top array<double>, seen long", "update", GroupStateTimeout.NoTimeout)


def run_topn(stream: DataFrame, key: Column, value: Column, n: int, out: str, checkpoint: str):
    """Follow a stream until its input is used up; the table ``out`` has the thresholds of every epoch."""
    def write(batch: DataFrame, epoch: int) -> None:
        write_table(batch.withColumn("epoch", F.lit(epoch).cast("long")), out, ["epoch"])

    q = (running_topn(stream, key, value, n).writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q

"""Registered streaming queries: replays of ``events`` and of lines built from ``orders``.

Each query runs its own replay: Spark writes the source below the shared
folder in ``STREAM_PARTS`` parts, and after every part the stream takes up the
new files as one micro-batch (``availableNow``, same checkpoint), so each
replay has several micro-batches and as many restarts of the query. Parts of
the events end at day borders and each micro-batch is cut by UTC day. The
queries read the job's output tables back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kmstream.plans import params as P
from kmstream.session import scratch_dir
from kmstream.sinks.tables import committed
from kmstream.sources.streams import read_parquet_stream, read_text_stream
from kmstream.sources.tables import table
from kmstream.streaming.jobs import AnomalyConfig, KMeansStreamJob, run_stream
from kmstream.streaming.online_kmeans import OnlineKMeans, StreamState, random_centers
from kmstream.streaming.prepare import FrozenFeatures
from kmstream.streaming.topn import run_topn

EVENT_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()),
                             T.StructField("value", T.DoubleType()),
                             T.StructField("event_type", T.StringType()),
                             T.StructField("day", T.DateType())])


def event_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.col("value").cast("double").alias("value"), "event_type",
                                             F.to_date("ts").alias("day"))


def event_parts(ev: DataFrame) -> list[DataFrame]:
    """The events in ``STREAM_PARTS`` runs of days, in order."""
    days = [r[0] for r in ev.select("day").distinct().orderBy("day").collect()]
    size = max(1, -(-len(days) // P.STREAM_PARTS))
    return [ev.where(F.col("day").between(days[i], days[min(i + size, len(days)) - 1])) for i in range(0, len(days), size)]


def replay(spark: SparkSession, sf: str, half_life: float | None = P.STREAM_HALF_LIFE, decay: float = 1.0,
           unit: str = "batches", prepare="raw", anomaly: bool = False, cols=("value",), init: StreamState | None = None, gaps: bool = False) -> str:
    """Run the streaming job over the event days, part by part (``gaps``: a micro-batch without rows after each); returns the folder of its tables."""
    src, out = scratch_dir(spark, "events-days"), scratch_dir(spark, "events-replay")
    model = OnlineKMeans(P.STREAM_K, decay_factor=decay, half_life=half_life, time_unit=unit)
    init = init or StreamState([list(c) for c in P.STREAM_STARTS], list(P.STREAM_WEIGHTS))
    job = KMeansStreamJob(model, init, list(cols), out, key_cols=["event_id"], batch_key="day", prepare=prepare,
                          anomaly=AnomalyConfig(P.STREAM_ANOMALY_K, P.STREAM_N_TOP, max_iter=P.LLOYD_ITERS) if anomaly else None)
    for part in event_parts(event_rows(spark, sf)):
        for rows in [part, part.limit(0)] if gaps else [part]:
            rows.write.mode("append").parquet(src)
            run_stream(read_parquet_stream(spark, src, EVENT_SCHEMA), job, out + "/_checkpoint")
    return out


def record_replay(spark: SparkSession, sf: str, job) -> str:
    """Run a text-line job over the order lines; part = order key modulo ``STREAM_PARTS``."""
    from kmstream.plans.batch import orders_lines
    src = scratch_dir(spark, "orders-lines")
    lines = orders_lines(spark, sf)
    for k in range(P.STREAM_PARTS):
        lines.filter(F.substring_index("value", ",", 1).cast("long") % P.STREAM_PARTS == k).write.mode("append").text(src)
        run_stream(read_text_stream(spark, src), job, job.out + "/_checkpoint")
    return job.out


def _final_state(spark, out) -> DataFrame:
    st = spark.read.parquet(out + "/state")
    last = st.agg(F.max("step").alias("s"))
    return (st.join(last, st["step"] == last["s"]).select(
        F.col("cluster").cast("long").alias("cluster"),
        F.round(F.col("center").getItem(0), 6).alias("center"),
        F.round(F.col("weight"), 6).alias("weight")))


def q_stream_kmeans_halflife(spark, sf):
    """G-2: half-life 5 batches (one batch = one UTC day)."""
    return _final_state(spark, replay(spark, sf))


def q_stream_kmeans_points(spark, sf):
    """G-5: explicit decay per row ("points" unit): a = 0.999 ** rows in the batch."""
    return _final_state(spark, replay(spark, sf, half_life=None, decay=P.STREAM_POINTS_DECAY,
                                      unit="points"))


def _pca_replay(spark, sf) -> str:
    feats = FrozenFeatures(["value"], ["event_type"], 2).fit(event_rows(spark, sf))
    return replay(spark, sf, prepare=feats, cols=["value", "event_type"], init=random_centers(P.STREAM_K, 2, 1.0, seed=7))


def q_stream_pca_rows(spark, sf):
    """G-12: per-batch features = frozen (encode event_type, PCA(2), z-score), fitted on all events.

    The online k-means (k = 2, seeded normal starts) trains on the 2 components.
    """
    return spark.read.parquet(_pca_replay(spark, sf) + "/prepared").select(
        "event_id", F.col("day").cast("string").alias("day"),
        F.round("pc1", 6).alias("pc1"), F.round("pc2", 6).alias("pc2"))


def q_stream_pca_facts(spark, sf):
    """G-12: every row of every day has finite components."""
    rows = spark.read.parquet(_pca_replay(spark, sf) + "/prepared")
    size = F.col("pc1") * F.col("pc1") + F.col("pc2") * F.col("pc2")
    return rows.groupBy(F.col("day").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.every(size < 1e9), F.lit(False)).alias("finite"))


def q_stream_file_rows(spark, sf):
    """A-2 / A-5: a directory of text files read as a stream (four files a micro-batch) and parsed.

    Spark writes the comma lines built from orders as text files; a
    ``readStream.text`` source with a file sink (``availableNow``) parses them;
    the query reads the sink table back.
    """
    from kmstream.plans.batch import ORDERS_LAYOUT, orders_lines
    from kmstream.sources.records import parse_records, split_fields
    src, out = scratch_dir(spark, "orders-lines"), scratch_dir(spark, "orders-parsed")
    orders_lines(spark, sf).write.mode("overwrite").text(src)
    lines = read_text_stream(spark, src, max_files_per_trigger=4)
    parsed = parse_records(lines, ORDERS_LAYOUT, "value").select(
        F.col("orderkey").cast("long").alias("line_key"),
        F.size(split_fields(F.col("value"), ",", ORDERS_LAYOUT.width)).cast("long").alias("n_fields"),
        "status", "bucket")
    q = (parsed.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", out + "_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


def _record_job(spark, name: str, prepare, anomaly: AnomalyConfig | None = None, texts: bool = False) -> KMeansStreamJob:
    from kmstream.plans.batch import ORDERS_LAYOUT
    cols = ["custkey", "bucket"]
    return KMeansStreamJob(OnlineKMeans(P.STREAM_K, decay_factor=1.0, split_dying=False), random_centers(P.STREAM_K, 2, 1.0, seed=7), cols,
                           scratch_dir(spark, name), key_cols=["orderkey", "value"], prepare=prepare, anomaly=anomaly,
                           layout=ORDERS_LAYOUT, texts=texts)


def _record_bootstrap(spark, sf) -> DataFrame:
    from kmstream.plans.batch import _parsed_orders
    return _parsed_orders(spark, sf)


def q_stream_prepared_rows(spark, sf):
    """C-9 / G-10 / B-6: text lines -> parse -> PCA -> z-score inside the stream.

    With all components of the two numbers, the squared length of a prepared row
    is its squared Mahalanobis distance, whatever the signs of the components."""
    feats = FrozenFeatures(["custkey", "bucket"], [], 2).fit(_record_bootstrap(spark, sf))
    out = record_replay(spark, sf, _record_job(spark, "record-prepared", feats))
    rows = spark.read.parquet(out + "/prepared")
    return rows.select(F.col("orderkey").cast("long").alias("line_key"), F.round(F.col("pc1") * F.col("pc1") + F.col("pc2") * F.col("pc2"), 4).alias("d2"))


def q_stream_kmeans_update(spark, sf):
    """The main job end to end: lines -> parse -> encode + PCA + z-score -> update -> predict, several micro-batches.

    With decay 1 the weights add up to the rows seen and the starting weights."""
    feats = FrozenFeatures(["custkey", "bucket"], ["status", "tail"], 2).fit(_record_bootstrap(spark, sf))
    out = record_replay(spark, sf, _record_job(spark, "record-update", feats, texts=True))
    state = spark.read.parquet(out + "/state")
    last = state.filter(F.col("step") == state.agg(F.max("step")).first()[0])
    seen = spark.read.parquet(out + "/metrics").agg(F.max("step").alias("steps"), F.sum("rows").alias("rows"))
    weight = last.agg(F.round(F.sum("weight"), 6).alias("weight"))
    near = spark.read.parquet(out + "/predictions").agg(F.count("cluster").alias("predicted"))
    return seen.join(weight).join(near)   # one row each


def q_stream_record_anomalies(spark, sf):
    """B-4 / G-13: per micro-batch a model of its own on the parsed numbers; the anomalous original lines."""
    conf = AnomalyConfig(P.STREAM_ANOMALY_K, P.STREAM_N_TOP, order_by="orderkey", max_iter=P.LLOYD_ITERS)
    out = record_replay(spark, sf, _record_job(spark, "record-anomalies", "raw", conf))
    return spark.read.parquet(out + "/anomalies").select(F.col("value").alias("line"), "cluster", F.round("dist", 6).alias("dist"))


def q_stream_anomaly_facts(spark, sf):
    """G-13 as composed: per micro-batch refitted encode + PCA + z-score, ten starts, top 100, original line."""
    conf = AnomalyConfig(P.STREAM_ANOMALY_K, P.N_TOP, order_by="orderkey", init="k-means||", runs=P.RESTARTS, tol=P.RESTART_TOL)
    feats = FrozenFeatures(["custkey", "bucket"], ["status", "tail"], 2)   # unfitted: refitted for every batch
    out = record_replay(spark, sf, _record_job(spark, "record-facts", feats, conf))
    found = spark.read.parquet(out + "/anomalies").groupBy("epoch").agg(
        F.count(F.lit(1)).alias("found"), F.every(F.col("value").startswith(F.concat(F.col("orderkey").cast("long").cast("string"), F.lit(",")))).alias("kept"))
    metrics = spark.read.parquet(out + "/metrics").select("epoch", "rows")
    return metrics.join(found, "epoch", "left").select(
        F.col("epoch").alias("batch"), "rows", (F.coalesce("found", F.lit(0)) < P.N_TOP).alias("fewer_than_n"), F.coalesce("kept", F.lit(True)).alias("lines_kept"))


def q_stream_kmeans_decay1(spark, sf):
    """G-1: decay factor 1.0 (all history weighs the same)."""
    return _final_state(spark, replay(spark, sf, half_life=None, decay=1.0))


def q_stream_latest_model(spark, sf):
    """G-14: the model after every batch, as the state table keeps it."""
    out = replay(spark, sf)
    return spark.read.parquet(out + "/state").select(
        F.col("batch_label").alias("day"), "step", "cluster", F.round(F.col("center").getItem(0), 6).alias("center"), F.round("weight", 6).alias("weight"))


def _metrics(spark, out) -> DataFrame:
    return spark.read.parquet(out + "/metrics").select(
        F.col("batch_label").alias("day"), "step", "rows", "running", "batch_k", "mean_k")


def q_stream_batch_counts(spark, sf):
    """G-9 / C-13: rows per processed batch."""
    return _metrics(spark, replay(spark, sf)).select(
        "day", F.col("step").alias("batch"), "rows")


def q_stream_running_count(spark, sf):
    """G-8: running row count over batches."""
    return _metrics(spark, replay(spark, sf)).select("day", "rows", "running")


def q_stream_k_estimate(spark, sf):
    """G-7: per-batch rule-of-thumb k and its integer running mean."""
    return _metrics(spark, replay(spark, sf)).select("day", "batch_k", "mean_k")


def q_stream_predictions(spark, sf):
    """G-6 / B-3: each row's cluster and distance under the model after its batch."""
    out = replay(spark, sf)
    return spark.read.parquet(out + "/predictions").select(
        "event_id", F.col("day").cast("string").alias("day"), "cluster",
        F.round("dist", 6).alias("dist"))


def q_stream_unit_scale(spark, sf):
    """G-11 / B-6: per-batch unit scaling (scaler refitted each batch)."""
    out = replay(spark, sf, prepare="unit_batch")
    return spark.read.parquet(out + "/prepared").select(
        "event_id", F.col("day").cast("string").alias("day"), F.round("value", 6).alias("scaled"))


def q_stream_topn_state(spark, sf):
    """F-20 / G-13 across batches: per event type the N-th largest distance to the nearest start of all rows so far, after every batch."""
    src, out = scratch_dir(spark, "events-days"), scratch_dir(spark, "events-topn")
    dist = F.least(*[F.abs(F.col("value") - F.lit(c[0])) for c in P.STREAM_STARTS])
    for part in event_parts(event_rows(spark, sf)):
        part.write.mode("append").parquet(src)
        run_topn(read_parquet_stream(spark, src, EVENT_SCHEMA), F.col("event_type"), dist, P.STREAM_N_TOP, out, out + "_checkpoint")
    return spark.read.parquet(out).select(F.col("epoch").cast("long").alias("epoch"), F.col("key").alias("event_type"), "seen", F.round("threshold", 6).alias("threshold"), "above")


def q_stream_empty_batch(spark, sf):
    """C-13 / C-14: micro-batches without rows between others are skipped; their epochs leave no rows."""
    out = replay(spark, sf, gaps=True)
    return committed(spark, out, "metrics").select("epoch", F.col("batch_label").alias("day"), F.col("step").alias("batch"), "rows")


def q_stream_running_scale(spark, sf):
    """G-11 / E-3: unit scaling by the deviation of all rows up to the day, merged batch by batch."""
    out = replay(spark, sf, prepare="unit_running")
    return committed(spark, out, "prepared").select(
        "event_id", F.col("day").cast("string").alias("day"), F.round("value", 6).alias("scaled"))


def q_stream_moments(spark, sf):
    """E-1 in a stream: count, mean and deviation of all rows after every day, from the state table."""
    out = replay(spark, sf, prepare="unit_running")
    days = committed(spark, out, "metrics").select("epoch", "step", F.col("batch_label").alias("day"))
    return committed(spark, out, "moments").join(days, ["epoch", "step"]).select(
        "day", "n", F.round("mean", 6).alias("mean"), F.round(F.sqrt(F.col("m2") / (F.col("n") - 1)), 6).alias("sd"))


def q_stream_committed_epochs(spark, sf):
    """B-1..B-6: what each committed epoch holds, over all its tables."""
    out = replay(spark, sf, anomaly=True)
    rows = committed(spark, out, "predictions").groupBy("epoch").agg(F.count(F.lit(1)).alias("predicted"), F.countDistinct("day").alias("days"))
    seen = committed(spark, out, "metrics").groupBy("epoch").agg(F.sum("rows").alias("rows"), F.max("running").alias("running"))
    state = committed(spark, out, "state").groupBy("epoch").agg(F.count(F.lit(1)).alias("centres"))
    found = committed(spark, out, "anomalies").groupBy("epoch").agg(F.count(F.lit(1)).alias("anomalies"))
    return seen.join(rows, "epoch").join(state, "epoch").join(found, "epoch")


def q_stream_anomalies(spark, sf):
    """G-13: per-batch z-score, fixed-start k-means, top-10 threshold, rows above it."""
    out = replay(spark, sf, anomaly=True)
    return spark.read.parquet(out + "/anomalies").select(
        "event_id", F.col("day").cast("string").alias("day"), "cluster",
        F.round("dist", 6).alias("dist"))


STREAM_QUERIES = {
    "stream_kmeans_halflife": q_stream_kmeans_halflife,
    "stream_kmeans_decay1": q_stream_kmeans_decay1,
    "stream_kmeans_points": q_stream_kmeans_points,
    "stream_file_rows": q_stream_file_rows,
    "stream_pca_rows": q_stream_pca_rows,
    "stream_latest_model": q_stream_latest_model,
    "stream_batch_counts": q_stream_batch_counts,
    "stream_running_count": q_stream_running_count,
    "stream_k_estimate": q_stream_k_estimate,
    "stream_predictions": q_stream_predictions,
    "stream_unit_scale": q_stream_unit_scale,
    "stream_prepared_rows": q_stream_prepared_rows,
    "stream_kmeans_update": q_stream_kmeans_update,
    "stream_record_anomalies": q_stream_record_anomalies,
    "stream_anomaly_facts": q_stream_anomaly_facts,
    "stream_pca_facts": q_stream_pca_facts,
    "stream_anomalies": q_stream_anomalies,
    "stream_empty_batch": q_stream_empty_batch,
    "stream_topn_state": q_stream_topn_state,
    "stream_running_scale": q_stream_running_scale,
    "stream_moments": q_stream_moments,
    "stream_committed_epochs": q_stream_committed_epochs,
}

"""G-4..G-13, B-2..B-7: the streaming k-means job as a ``foreachBatch`` function.

Per micro-batch (``epoch``):

1. skip an empty batch (C-13);
2. restore the model: the in-memory state when it belongs to epoch - 1,
   otherwise the newest state row with a smaller epoch from the state table
   (restart, or a re-executed batch after a failure);
3. optional ``layout``: text lines (column ``value``) are parsed into records
   and the line stays beside them, through predictions and anomalies;
4. optional ``batch_key``: the batch is cut by that column and the pieces are
   applied in key order, one update each. A key whose rows arrive in two
   micro-batches is two updates; cut the source at key borders
   (``maxFilesPerTrigger``) where that matters. Null keys are a piece of their
   own, applied first;
5. per step: prepare (identity, unit scaling or features refitted per step,
   unit scaling by the moments of all rows so far, or a frozen feature model),
   update (one aggregation scan), predict (map-only), metrics (G-7..G-9);
6. write every output partitioned by ``epoch`` with dynamic partition
   overwrite, so an at-least-once re-execution replaces its own output, and then
   the epoch's manifest. ``sinks.tables.committed`` reads only committed epochs,
   and so does the restore of the model, so a job killed between two tables shows
   no half epoch.

Nothing is collected except k x d sums, the distinct batch keys of the
micro-batch and one metrics row per step.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kmstream.functions.stats import k_rule_of_thumb
from kmstream.functions.vectors import with_keyed_assignment
from kmstream.operators.anomaly import AnomalyDetector, grouped_anomalies
from kmstream.operators.scale import RunningMoments, UnitScale
from kmstream.sinks.tables import centers_text, commit, committed, withdraw, write_table, write_text
from kmstream.sources.records import Layout, parse_records
from kmstream.streaming.online_kmeans import OnlineKMeans, StreamState

STATE_SCHEMA = ("epoch long, step long, batch_label string, cluster long, "
                "center array<double>, weight double")
MOMENT_SCHEMA = "epoch long, step long, column string, n long, mean double, m2 double"
METRIC_SCHEMA = ("epoch long, step long, batch_label string, rows long, running long, "
                 "batch_k long, mean_k long, k_sum long")

#: Stands for "the whole batch is one piece"; None is the null key.
WHOLE = object()


def _key_text(col: str):
    """A batch key as a string that tells null from every value."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit("null"))


@dataclass
class AnomalyConfig:
    k: int = 2
    n_top: int = 10
    order_by: str = "event_id"
    max_iter: int = 20
    init: str = "fixed"    # or "k-means||": ``runs`` random starts
    runs: int = 10
    tol: float = 0.0


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


class KMeansStreamJob:
    """``prepare``: 'raw', 'unit_batch', 'unit_running' (the deviation of all rows up to
    the step, kept as mergeable moments in the table ``moments``), a fitted feature
    model (frozen), or an unfitted ``FrozenFeatures`` (refitted per step). ``layout``: parse text lines first.
    ``texts``: also write the centres as text lines and a scatter table per batch."""

    def __init__(self, model: OnlineKMeans, init: StreamState, feature_cols: Sequence[str],
                 out_dir: str, key_cols: Sequence[str] = (), batch_key: str | None = None,
                 prepare="raw", anomaly: AnomalyConfig | None = None, layout: Layout | None = None,
                 parse_mode: str = "fail", texts: bool = False):
        if isinstance(prepare, str) and prepare not in ("raw", "unit_batch", "unit_running") or not (isinstance(prepare, str) or hasattr(prepare, "fit") or hasattr(prepare, "transform")):
            raise ValueError("prepare must be 'raw', 'unit_batch', 'unit_running' or a feature model")
        self.model, self.init = model, init
        self.cols, self.keys = list(feature_cols), list(key_cols)
        # the model trains on what preparation produces (one frame feeds both, D7)
        self.model_cols = list(prepare.cols) if hasattr(prepare, "cols") else self.cols
        self.out, self.batch_key, self.prepare, self.anomaly = out_dir, batch_key, prepare, anomaly
        self.layout, self.parse_mode, self.texts = layout, parse_mode, texts
        self._state: StreamState | None = None
        self._epoch: int | None = None
        self._moments: RunningMoments | None = None

    @property
    def prepare_name(self) -> str | None:
        return self.prepare if isinstance(self.prepare, str) else None

    # paths -------------------------------------------------------------------
    def path(self, name: str) -> str:
        return os.path.join(self.out, name)

    # state -------------------------------------------------------------------
    def restore(self, spark: SparkSession, epoch: int) -> StreamState:
        if self._state is not None and self._epoch == epoch - 1:
            return self._state.copy()
        self._moments = RunningMoments.none(self.cols)
        if not _exists(spark, self.path("commits")):
            return self.init.copy()
        prev = committed(spark, self.out, "state").where(F.col("epoch") < epoch)
        last = prev.agg(F.max(F.struct("epoch", "step")).alias("m")).first()["m"]
        if last is None:
            return self.init.copy()
        if self.prepare_name == "unit_running":
            held = committed(spark, self.out, "moments").where((F.col("epoch") == last["epoch"]) & (F.col("step") == last["step"]))
            by_col = {r["column"]: r for r in held.collect()}
            self._moments = RunningMoments(self.cols, *[[by_col[c][k] for c in self.cols] for k in ("n", "mean", "m2")])
        rows = (prev.where((F.col("epoch") == last["epoch"]) & (F.col("step") == last["step"]))
                .orderBy("cluster").collect())
        met = (committed(spark, self.out, "metrics")
               .where((F.col("epoch") == last["epoch"]) & (F.col("step") == last["step"])).first())
        return StreamState([list(r["center"]) for r in rows], [float(r["weight"]) for r in rows],
                           int(last["step"]), int(met["running"]), int(met["k_sum"]))

    # one micro-batch -----------------------------------------------------------
    def _prepare(self, sub: DataFrame) -> DataFrame:
        if hasattr(self.prepare, "transform"):          # frozen encode + PCA + z-score
            return self.prepare.transform(sub)
        if hasattr(self.prepare, "fit"):                # refitted on these rows
            return self.prepare.fit(sub).transform(sub)
        if self.prepare == "unit_batch":
            return UnitScale(self.cols).fit(sub).transform(sub)
        if self.prepare == "unit_running":
            self._moments = (self._moments or RunningMoments.none(self.cols)).merge(RunningMoments.of(sub, self.cols))
            return self._moments.unit_scale().transform(sub)
        return sub

    def __call__(self, batch_df: DataFrame, epoch_id: int) -> None:
        self.process(batch_df, epoch_id)

    def process(self, batch_df: DataFrame, epoch_id: int) -> None:
        spark = batch_df.sparkSession
        if batch_df.isEmpty():
            return                       # C-13 / C-14
        state = self.restore(spark, epoch_id)
        before_batch = self._moments
        if self.layout is not None:
            batch_df = parse_records(batch_df, self.layout, "value", self.parse_mode, keep_line=True)
        frozen = hasattr(self.prepare, "transform")
        per_step = not frozen and not (isinstance(self.prepare, str) and self.prepare == "raw")
        if frozen:
            # a frozen preparation does not depend on the batch: apply it once
            batch_df = self.prepare.transform(batch_df)
        if self.batch_key:
            # local sort only (no shuffle): cached column batches then carry narrow
            # key ranges, so each per-key filter skips the other keys' batches
            batch_df = batch_df.sortWithinPartitions(self.batch_key)
        data = batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        keep = self.keys + ([self.batch_key] if self.batch_key else [])
        try:
            labels = [WHOLE]
            if self.batch_key:
                labels = [r[0] for r in data.select(self.batch_key).distinct().orderBy(F.asc_nulls_first(self.batch_key)).collect()]
            state_rows, metric_rows, step_models, step_no, pieces, anomalies = [], [], {}, {}, [], []
            moment_rows: list[tuple] = []
            for lab in labels:
                sub = data if lab is WHOLE else data.where(F.col(self.batch_key).eqNullSafe(F.lit(lab)))
                prep = self._prepare(sub) if per_step else sub
                before = state.rows_seen
                state = self.model.update(state, prep, self.model_cols)
                m = state.rows_seen - before
                bk = k_rule_of_thumb(m)
                state.k_sum += bk
                label = str(epoch_id) if lab is WHOLE else "null" if lab is None else str(lab)
                metric_rows.append((epoch_id, state.step, label, m, state.rows_seen, bk,
                                    state.k_sum // state.step, state.k_sum))
                for j, (c, w) in enumerate(zip(state.centers, state.weights)):
                    state_rows.append((epoch_id, state.step, label, j, [float(v) for v in c], float(w)))
                if self.prepare_name == "unit_running":
                    mo = self._moments
                    moment_rows += [(epoch_id, state.step, c, *x) for c, *x in zip(self.cols, mo.n, mo.mean, mo.m2)]
                text = "whole" if lab is WHOLE else "null" if lab is None else f"={lab}"
                step_models[text], step_no[text] = [list(c) for c in state.centers], state.step
                if per_step:
                    pieces.append(prep)
            # G-6: update first, then predict each key's rows with that key's model, in one pass
            prepared = data
            if per_step:
                prepared = pieces[0]
                for piece in pieces[1:]:
                    prepared = prepared.unionByName(piece)
                prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)
            key = _key_text(self.batch_key) if self.batch_key else F.lit("whole")
            steps = spark.createDataFrame(list(step_no.items()), "_key string, step long")
            keyed = prepared.withColumn("_key", key).join(steps, "_key", "left")
            pred = with_keyed_assignment(keyed, F.col("_key"), [F.col(c).cast("double") for c in self.model_cols], step_models)
            preds = pred.select(*keep, "step", F.col("cluster").cast("long").alias("cluster"), "dist")
            shown = None
            if frozen or per_step:
                shown = keyed.select(*keep, *self.model_cols, "step")
            scatter = None
            if self.texts:
                points = pred.select(F.lit("row").alias("kind"), "step", F.col(self.model_cols[0]).cast("double").alias("x"),
                                     F.col(self.model_cols[-1]).cast("double").alias("y"), F.col("cluster").cast("long").alias("cluster"))
                centres = [("centre", r[1], r[4][0], r[4][-1], r[3]) for r in state_rows]
                scatter = points.unionByName(spark.createDataFrame(centres, "kind string, step long, x double, y double, cluster long"))
            if self.anomaly:
                anomalies.append(self._anomalies(prepared, keep))
            self._write(spark, epoch_id, state_rows, metric_rows, preds, shown, anomalies, scatter, moment_rows)
            self._state, self._epoch = state, epoch_id
            if per_step:
                prepared.unpersist()
        except BaseException:
            self._state, self._moments = None, before_batch     # the epoch is read back from the tables when it is run again
            raise
        finally:
            data.unpersist()

    def _anomalies(self, prepared: DataFrame, keep: list[str]) -> DataFrame:
        """G-13: a model of its own per key (or per batch) on the prepared rows; the keys keep the original line."""
        a = self.anomaly
        if self.batch_key:
            # all keys of the batch fitted together
            named = prepared.withColumn("_group", _key_text(self.batch_key))
            flagged = grouped_anomalies(named, "_group", a.order_by, self.model_cols, a.k, a.n_top, a.max_iter, keep=keep)
        else:
            det = AnomalyDetector(self.model_cols, k=a.k, n_top=a.n_top, init=a.init, order_by=a.order_by,
                                  max_iter=a.max_iter, tol=a.tol, runs=a.runs)
            flagged = det.fit(prepared).transform(prepared).where(F.col("is_anomaly"))
        return flagged.select(*keep, F.col("cluster").cast("long").alias("cluster"), "dist")

    def _write(self, spark, epoch, state_rows, metric_rows, preds, prepared, anomalies, scatter, moment_rows):
        withdraw(spark, self.out, epoch)
        names = []

        def w(df, name):
            write_table(df.withColumn("epoch", F.lit(epoch).cast("long")), self.path(name), ["epoch"])
            names.append(name)
        w(preds, "predictions")
        if prepared is not None:
            w(prepared, "prepared")
        if scatter is not None:
            w(scatter, "scatter")
        for a in anomalies:
            w(a, "anomalies")
        # small tables: k rows and one metrics row per step; I-4: when the batch was processed
        w(spark.createDataFrame(metric_rows, METRIC_SCHEMA).withColumn("processed_at", F.current_timestamp()), "metrics")
        if moment_rows:
            w(spark.createDataFrame(moment_rows, MOMENT_SCHEMA), "moments")
        states = spark.createDataFrame(state_rows, STATE_SCHEMA)
        if self.texts:
            last = states.filter(F.col("step") == max(r[1] for r in state_rows)).orderBy("cluster")
            write_text(centers_text(last, "center"), "line", self.path(f"centers_text/epoch={epoch}"))
        w(states, "state")
        commit(spark, self.out, epoch, names)


def run_stream(stream: DataFrame, job: KMeansStreamJob, checkpoint: str,
               available_now: bool = True, processing_time: str | None = None):
    """Start the job on a stream (A-4 trigger) and wait when ``available_now``."""
    w = stream.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q

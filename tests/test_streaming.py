"""G-1..G-14: online k-means rule, file-stream job, restart from checkpoint."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kmstream.session import scratch_dir
from kmstream.sources.streams import read_parquet_stream
from kmstream.streaming.jobs import KMeansStreamJob, run_stream
from kmstream.streaming.online_kmeans import (OnlineKMeans, StreamState, decay_from_half_life,
                                              random_centers)

SF = "/root/testdata/sf0.001"


def _state():
    return StreamState([[0.0, 0.0], [10.0, 10.0]], [1.0, 1.0])


@pytest.mark.parametrize("rows,unit,centres,weights", [
    ([(1, 1), (2, 2), (9, 9)], "batches", [[1.2, 1.2], [9.333333, 9.333333]], [2.5, 1.5]),
    ([(1, 1), (2, 2), (9, 9)], "points", [[1.411765, 1.411765], [9.111111, 9.111111]], [2.125, 1.125]),
    ([(1, 1), (2, 2)], "batches", [[1.2, 1.2], [10.0, 10.0]], [2.5, 0.5]),
])
def test_update_vectors(spark, rows, unit, centres, weights):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in rows], "x double, y double")
    m = OnlineKMeans(2, decay_factor=0.5, time_unit=unit)
    st = m.update(_state(), df, ["x", "y"])
    assert np.allclose(st.centers, centres, atol=1e-6)
    assert np.allclose(st.weights, weights)


def test_dimension_mismatch_raises(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    with pytest.raises(ValueError):
        OnlineKMeans(2).update(_state(), df, ["a", "b", "c"])


def test_half_life_and_random_centres():
    assert decay_from_half_life(5) == pytest.approx(0.5 ** (1 / 5))
    st = random_centers(3, 4, 0.0, seed=1)
    assert len(st.centers) == 3 and all(len(c) == 4 for c in st.centers)


def test_k1_alpha1_is_global_mean_for_any_split(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("value", F.to_date("ts").alias("day"))
    m = OnlineKMeans(1, decay_factor=1.0)
    st = StreamState([[0.0]], [0.0])
    for (d,) in ev.select("day").distinct().orderBy("day").collect():
        st = m.update(st, ev.where(F.col("day") == d), ["value"])
    mean = ev.agg(F.avg("value")).first()[0]
    assert st.centers[0][0] == pytest.approx(mean)
    st2 = m.update(StreamState([[0.0]], [0.0]), ev, ["value"])
    assert st2.centers[0][0] == pytest.approx(mean)


def _write_days(spark, path, days):
    ev = spark.read.parquet(f"{SF}/events.parquet").select(
        "event_id", F.col("value").cast("double").alias("value"), "event_type", F.to_date("ts").alias("day"))
    ev.where(F.col("day").isin(days)).write.mode("append").partitionBy("day").parquet(path)


def _job(out):
    model = OnlineKMeans(2, half_life=5.0)
    return KMeansStreamJob(model, StreamState([[10.0], [200.0]], [1.0, 1.0]), ["value"], out,
                           key_cols=["event_id"], batch_key="day")


def _final(spark, out):
    st = spark.read.parquet(out + "/state")
    last = st.agg(F.max("step")).first()[0]
    rows = st.where(F.col("step") == last).orderBy("cluster").collect()
    return last, [r["center"][0] for r in rows], [r["weight"] for r in rows]


def test_restart_from_checkpoint_equals_one_run(spark):
    from kmstream.plans.stream import EVENT_SCHEMA
    ev = spark.read.parquet(f"{SF}/events.parquet").select(F.to_date("ts").alias("day"))
    days = [r[0] for r in ev.distinct().orderBy("day").collect()]
    first, second = days[: len(days) // 2], days[len(days) // 2:]

    src, out = scratch_dir(spark, "t-src"), scratch_dir(spark, "t-out")
    _write_days(spark, src, first)
    run_stream(read_parquet_stream(spark, src, EVENT_SCHEMA), _job(out), out + "/_ck")
    _write_days(spark, src, second)
    # a new job object: state must come back from the state table
    run_stream(read_parquet_stream(spark, src, EVENT_SCHEMA), _job(out), out + "/_ck")

    src2, out2 = scratch_dir(spark, "t-src"), scratch_dir(spark, "t-out")
    _write_days(spark, src2, days)
    run_stream(read_parquet_stream(spark, src2, EVENT_SCHEMA), _job(out2), out2 + "/_ck")

    a, b = _final(spark, out), _final(spark, out2)
    assert a[0] == b[0] == len(days)
    assert np.allclose(a[1], b[1]) and np.allclose(a[2], b[2])
    met = spark.read.parquet(out + "/metrics").agg(F.max("running")).first()[0]
    assert met == spark.read.parquet(f"{SF}/events.parquet").count()


def test_reexecuted_batch_overwrites_its_output(spark):
    out = scratch_dir(spark, "t-re")
    ev = spark.read.parquet(f"{SF}/events.parquet").select(
        "event_id", F.col("value").cast("double").alias("value"), F.to_date("ts").alias("day"))
    job = _job(out)
    job.process(ev, 0)
    first = _final(spark, out)
    job2 = _job(out)            # as after a crash: same epoch again
    job2.process(ev, 0)
    assert _final(spark, out) == first
    assert spark.read.parquet(out + "/predictions").count() == ev.count()


def test_frozen_features_match_vector_projection(spark):
    from kmstream.operators.encode import encode_features
    from kmstream.operators.reduce import project_vector
    from kmstream.streaming.prepare import FrozenFeatures
    rows = [(float(i % 7) * 3.0 + (i % 3), ["a", "b", "c"][i % 3]) for i in range(40)]
    df = spark.createDataFrame(rows, "v double, t string")
    model = FrozenFeatures(["v"], ["t"], 2).fit(df)
    got = model.transform(df.withColumn("rid", F.monotonically_increasing_id()))
    vec, _ = encode_features(df.withColumn("rid", F.monotonically_increasing_id()), ["v"], ["t"], "f",
                             model=model.encoder)
    ref = project_vector(vec, model.pca, "f", "p").select(
        "rid", F.col("p")[0].alias("r1"), F.col("p")[1].alias("r2"))
    z = model.zscore
    both = got.join(ref, "rid").collect()
    for r in both:
        assert r["pc1"] == pytest.approx((r["r1"] - z.means[0]) / z.sds[0], abs=1e-9)
        assert r["pc2"] == pytest.approx((r["r2"] - z.means[1]) / z.sds[1], abs=1e-9)
    unseen = spark.createDataFrame([(1.0, "zzz"), (1.0, None)], "v double, t string").collect()
    got = model.transform(spark.createDataFrame(unseen, "v double, t string")).collect()   # they contribute 0
    for r in got:
        for j in (0, 1):
            assert r[f"pc{j + 1}"] == pytest.approx((model.pca.components[0, j] - z.means[j]) / z.sds[j], abs=1e-9)


def test_dying_cluster_is_split():
    m = OnlineKMeans(2, decay_factor=1.0)
    st = StreamState([[0.0, 0.0], [5.0, 5.0]], [1e-12, 1.0])
    new = m.apply(st, {1: ([10.0, 10.0], 2)})
    w = (3.0 + 1e-12) / 2.0
    assert new.weights == pytest.approx([w, w])
    big = [(1.0 / 3.0) * 5.0 + (2.0 / 3.0) * 5.0] * 2
    assert new.centers[1] == pytest.approx([b + 1e-14 * b for b in big])
    assert new.centers[0] == pytest.approx([b - 1e-14 * b for b in big])
    off = OnlineKMeans(2, decay_factor=1.0, split_dying=False).apply(st, {1: ([10.0, 10.0], 2)})
    assert off.weights == pytest.approx([1e-12, 3.0])


def test_console_sink_prints_batches(spark):
    from kmstream.plans.stream import EVENT_SCHEMA
    from kmstream.sinks.tables import console
    src, ck = scratch_dir(spark, "t-con"), scratch_dir(spark, "t-con-ck")
    _write_days(spark, src, [r[0] for r in spark.read.parquet(f"{SF}/events.parquet")
                             .select(F.to_date("ts")).distinct().limit(2).collect()])
    q = console(read_parquet_stream(spark, src, EVENT_SCHEMA), rows=3, available_now=True,
                checkpoint=ck)
    assert sum(p["numInputRows"] for p in q.recentProgress) > 0


def test_null_batch_key_is_a_piece_of_its_own(spark):
    rows = [(i, float(i), "a" if i < 10 else "b") for i in range(20)] + [(20, 7.0, None)]
    df = spark.createDataFrame(rows, "event_id long, value double, day string")
    out = scratch_dir(spark, "t-null")
    _job(out).process(df, 0)
    met = spark.read.parquet(out + "/metrics").orderBy("step").collect()
    assert [(r["batch_label"], r["rows"], r["running"]) for r in met] == [("null", 1, 1), ("a", 10, 11), ("b", 10, 21)]
    assert all(r["processed_at"] is not None for r in met)                       # I-4
    assert spark.read.parquet(out + "/predictions").filter("cluster is null").count() == 0


def test_incomplete_rows_are_left_out_of_the_update(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (float("nan"),)], "x double")
    st = OnlineKMeans(1, decay_factor=1.0).update(StreamState([[0.0]], [0.0]), df, ["x"])
    assert st.centers == [[2.0]] and st.weights == [2.0] and st.rows_seen == 2


def test_empty_micro_batch_changes_nothing(spark):
    out = scratch_dir(spark, "t-empty")
    job = _job(out)
    ev = spark.createDataFrame([(1, 5.0, "a")], "event_id long, value double, day string")
    job.process(ev, 0)
    before = _final(spark, out)
    job.process(ev.filter("false"), 1)
    assert _final(spark, out) == before
    assert [r[0] for r in spark.read.parquet(out + "/metrics").select("epoch").collect()] == [0]


def test_key_split_over_micro_batches_is_two_updates(spark):
    """What the job's documentation says: cut the source at key borders where that matters."""
    day = spark.createDataFrame([(i, float(i), "a") for i in range(4)], "event_id long, value double, day string")
    out = scratch_dir(spark, "t-split")
    job = _job(out)
    job.process(day.filter("event_id < 2"), 0)
    job.process(day.filter("event_id >= 2"), 1)
    assert [r["batch_label"] for r in spark.read.parquet(out + "/metrics").orderBy("step").collect()] == ["a", "a"]


def test_refitted_features_text_lines_and_texts(spark):
    """Text lines -> refitted encode + PCA + z-score -> update -> anomalies with the original line."""
    from kmstream.sources.records import CATEGORY, LABEL, NUMERIC, Layout
    from kmstream.streaming.jobs import AnomalyConfig
    from kmstream.streaming.prepare import FrozenFeatures
    layout = Layout.of([("id", NUMERIC), ("x", NUMERIC), ("kind", CATEGORY), ("label", LABEL)])
    lines = spark.createDataFrame([(f"{i},{i % 9 if i != 33 else 500},{'pq'[i % 2]},z",) for i in range(60)], "value string")
    out = scratch_dir(spark, "t-lines")
    job = KMeansStreamJob(OnlineKMeans(2), random_centers(2, 2, 1.0), ["x"], out, key_cols=["id", "value"], layout=layout,
                          prepare=FrozenFeatures(["x"], ["kind"], 2), texts=True,
                          anomaly=AnomalyConfig(2, 2, order_by="id", init="k-means||", runs=3))
    job.process(lines, 0)
    job.process(lines.limit(20), 1)          # another width is fine: the features are refitted
    found = spark.read.parquet(out + "/anomalies").filter("epoch = 0").collect()
    assert len(found) == 1 and found[0]["value"].startswith(f"{int(found[0]['id'])},")
    assert spark.read.parquet(out + "/prepared").count() == 80
    assert spark.read.parquet(out + "/scatter").filter("kind = 'centre'").count() == 4
    assert spark.read.text(out + "/centers_text/epoch=0").count() == 2


def test_processing_time_trigger(spark):
    from kmstream.plans.stream import EVENT_SCHEMA
    src, out = scratch_dir(spark, "t-src"), scratch_dir(spark, "t-out")
    day = spark.read.parquet(f"{SF}/events.parquet").select(F.to_date("ts")).first()[0]
    _write_days(spark, src, [day])
    q = run_stream(read_parquet_stream(spark, src, EVENT_SCHEMA), _job(out), out + "/_ck", available_now=False,
                   processing_time="1 second")
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(out + "/metrics").count() == 1


def test_job_killed_between_tables_shows_no_half_epoch(spark, monkeypatch):
    """An epoch is seen in all tables or in none; run again, it is the epoch of an unbroken job."""
    from kmstream.sinks.tables import committed
    from kmstream.streaming import jobs
    days = [spark.createDataFrame([(10 * e + i, float(7 * e + i * i), "ab"[i % 2]) for i in range(8)], "event_id long, value double, day string") for e in range(3)]
    names = ("predictions", "prepared", "metrics", "moments", "state")

    def rows(out, name):
        cols = [c for c in committed(spark, out, name).columns if c != "processed_at"]
        return sorted(map(str, committed(spark, out, name).select(*cols).collect()))

    def job(out):
        return KMeansStreamJob(OnlineKMeans(2, half_life=2.0), StreamState([[1.0], [50.0]], [1.0, 1.0]), ["value"], out,
                               key_cols=["event_id"], batch_key="day", prepare="unit_running")
    whole, cut = scratch_dir(spark, "t-whole"), scratch_dir(spark, "t-cut")
    plain, broken = job(whole), job(cut)
    for e, day in enumerate(days):
        plain.process(day, e)
    broken.process(days[0], 0)
    one = {n: rows(cut, n) for n in names}
    write = jobs.write_table

    def dies(df, path, *a, **k):
        if path.endswith("/state"):
            raise OSError("killed")
        return write(df, path, *a, **k)
    monkeypatch.setattr(jobs, "write_table", dies)
    with pytest.raises(OSError):
        broken.process(days[1], 1)
    assert spark.read.parquet(cut + "/predictions").filter("epoch = 1").count() == 8
    assert {n: rows(cut, n) for n in names} == one
    monkeypatch.setattr(jobs, "write_table", write)
    again = job(cut)                           # a new driver
    again.process(days[1], 1)
    again.process(days[2], 2)
    again._state = None
    again.process(days[2], 2)                  # a replayed epoch replaces itself
    assert all(rows(cut, n) == rows(whole, n) for n in names)


def test_running_moments_do_not_depend_on_the_split(spark):
    from kmstream.operators.scale import RunningMoments
    rows = [(float(i * i % 13) + 1e6, float(i)) for i in range(40)] + [(None, 1.0), (float("nan"), 2.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, a double, b double")
    whole = RunningMoments.of(df, ["a", "b"])
    for size in (1, 7, 41):
        parts = RunningMoments.none(["a", "b"])
        for at in range(0, 42, size) if size > 1 else (0, 1, 2, 39, 40, 41):
            parts = parts.merge(RunningMoments.of(df.filter(f"i >= {at} and i < {at + size}"), ["a", "b"]))
        if size > 1:
            assert parts.n == whole.n == [40, 42]
            assert parts.mean == pytest.approx(whole.mean) and parts.m2 == pytest.approx(whole.m2, rel=1e-6)
    sd = whole.unit_scale().sds
    want = df.selectExpr("stddev_samp(nanvl(a, null))", "stddev_samp(b)").first()
    assert sd == pytest.approx(list(want))
    assert RunningMoments.of(df.limit(0), ["a"]).unit_scale().sds == [0.0]

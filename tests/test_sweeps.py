"""Sweeps over every k search few rows and keep no state between scans."""

import numpy as np
import pytest

from kmstream.functions import vectors
from kmstream.operators import blocks
from kmstream.operators.cluster import lloyd
from kmstream.plans import batch


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    rng = np.random.default_rng(6)
    rows = [(i, int(s), float(p)) for i, (s, p) in enumerate(zip(rng.integers(1, 51, 400), rng.random(400).round(3) * 100 + 900))]
    at = tmp_path_factory.mktemp("sweep")
    spark.createDataFrame([*rows, (400, None, 5.0), (401, 3, None)], "p_partkey long, p_size int, p_retailprice double").write.parquet(f"{at}/part.parquet")
    return str(at)


@pytest.mark.parametrize("name", ["elbow_scores", "elbow_scores_scaled"])
def test_elbow_sweep_takes_boxes_not_all_centres(spark, parts, monkeypatch, name):
    data, res = batch._part_lloyd(spark, parts, name.endswith("scaled"), 4)     # one model: the plain scan
    plain = lloyd(data, batch.P.PART_COLS, {4: batch.first_rows_init(data, batch.P.PART_COLS, "p_partkey", 4)}, 20, 0.0)[4]
    assert res[4].centers == plain.centers
    seen = []
    monkeypatch.setattr(batch, "sweep_lloyd", lambda *a, **b: seen.append(blocks.sweep_lloyd(*a, **b)) or seen[-1])
    out = {r["k"]: r["score"] for r in batch.QUERIES[name](spark, parts).collect()}
    assert len(seen) == 1 and list(out) == list(range(1, 15))
    assert out[4] == pytest.approx(plain.mean_distance, abs=1e-6)
    assert np.allclose(seen[0][4].centers, plain.centers, rtol=0, atol=1e-9) and seen[0][4].sizes == plain.sizes


def test_scans_write_nothing(spark, monkeypatch):
    frame = spark.createDataFrame([(float(i % 17), float(i % 5)) for i in range(200)], "a double, b double")
    flat, d, array = blocks._flat(frame, ["a", "b"])
    packed, _ = blocks.pack(spark, flat, d, array)
    monkeypatch.setattr(blocks, "stored", lambda *a, **b: pytest.fail("a scan wrote rows"))
    fit = blocks.bounded_lloyd(spark, packed, d, {3: [[0.0, 0.0], [8.0, 2.0], [16.0, 4.0]]})[3]
    assert fit.n == 200 and sum(fit.sizes) == 200


def test_library_fit_reads_even_parts(spark, monkeypatch):
    """A split that holds nearly all rows is no longer one cached part."""
    rng = np.random.default_rng(2)
    rows = spark.createDataFrame(rng.random((20_000, 4)).tolist(), ", ".join(f"{c} double" for c in batch.P.LINEITEM_COLS)).coalesce(1)
    rows = rows.union(spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], rows.schema))
    seen = []
    monkeypatch.setattr(batch, "fit_kmeans", lambda feats, k, seed: seen.extend(r["n"] for r in feats.groupBy(batch.F.spark_partition_id()).agg(batch.F.count("*").alias("n")).collect()))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "64k")
    try:
        batch._library_fit(rows)
    finally:
        spark.conf.set(name, before)
    assert len(seen) > 1 and sum(seen) == 20_001 and max(seen) < 15_000


@pytest.mark.parametrize("runs", [1, 3])
def test_restarts_search_candidates_in_boxes(spark, monkeypatch, runs):
    """Starts and scans both go through the boxes; a plain search would compare every row with every candidate."""
    from kmstream.operators import restarts
    rng = np.random.default_rng(3)
    frame = spark.createDataFrame(rng.random((3000, 2)).tolist(), "a double, b double")
    count = blocks.ScanCount()
    fits = restarts.fit_restarts(frame, ["a", "b"], [2, 6], runs=runs, count=count)
    assert all(f.n == 3000 for f in fits.values()) and fits[6].cost < fits[2].cost
    assert count.skipped > 0.7


def test_record_lines_are_parsed_once(spark, tmp_path):
    """The features' steps read typed records; a filter on them would parse the lines again for every column it names."""
    rows = [(i, i % 7, "OFP"[i % 3], f"{1 + i % 5}-X") for i in range(60)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    prepared, feats = batch._record_features(spark, str(tmp_path))
    plan = prepared.filter(batch.F.col(feats.cols[0]).isNotNull())._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and "split(" not in plan
    assert prepared.count() == 60 and "value" in prepared.columns


def test_entropy_sweep_puts_rows_in_blocks(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(batch, "sweep_lloyd", lambda *a, **b: seen.append(blocks.sweep_lloyd(*a, **b)) or seen[-1])
    batch.q_entropy_sweep(spark, "/root/testdata/sf0.001")
    assert len(seen) == 1

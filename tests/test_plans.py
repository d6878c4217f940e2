"""Plan-shape guards for the properties the design relies on at scale."""

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_text(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_flagship_is_map_only_over_pruned_scan(spark):
    df = E.queries()["anomaly_rows"](spark, SF)
    plan = plan_text(df)
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1     # map-only after the model is fitted
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int,p_retailprice:double>" in \
        df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_weighted_entropy_scans_once(spark):
    df = E.queries()["weighted_entropy"](spark, SF)
    opt = optimized_text(df)
    assert len(re.findall(r"Relation \[[^\]]*embedding", opt)) == 1
    assert "Join" not in opt


def test_sweep_scores_send_only_partial_sums(spark):
    """No rows x models frame: what leaves Python is grouped right away."""
    from kmstream.functions.vectors import ArrayVec
    from kmstream.operators.cluster import label_counts
    emb = spark.read.parquet(f"{SF}/embeddings.parquet").selectExpr("label", "cast(embedding as array<double>) as emb")
    plan = plan_text(label_counts(emb, ArrayVec("emb", 64), {k: [[0.0] * 64] * k for k in (1, 2, 3)}, "label"))
    assert re.search(r"HashAggregate[^\n]*partial_sum[^\n]*\n[^\n]*(Project[^\n]*\n[^\n]*)?MapInPandas", plan)
    assert "Generate" not in plan


def test_frozen_projection_does_not_grow_with_categories(spark):
    from kmstream.streaming.prepare import FrozenFeatures
    sizes = []
    for n in (4, 400):
        df = spark.createDataFrame([(float(i), f"c{i % n}") for i in range(800)], "v double, t string")
        sizes.append(len(optimized_text(FrozenFeatures(["v"], ["t"], 2).fit(df).transform(df))))
    assert abs(sizes[1] - sizes[0]) < 400


def test_threshold_uses_top_n_not_full_sort(spark):
    assert "TakeOrderedAndProject" in plan_text(E.queries()["topn_threshold"](spark, SF))


def test_column_stats_is_one_aggregation(spark):
    df = E.queries()["column_stats"](spark, SF)
    opt = optimized_text(df)
    assert opt.count("Aggregate") == 1 and len(re.findall(r"Relation \[", opt)) == 1

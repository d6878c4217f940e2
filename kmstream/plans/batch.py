"""Registered batch queries: each takes (spark, sf_dir) and returns a DataFrame.

Names, columns and rounding match the SQL oracles in
:mod:`kmstream.plans.oracle`. Every query reads whole test tables; the only
values that pass through the driver are model parameters (k x d centres,
2 numbers per scaled column, an N-th largest distance).
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kmstream.functions.stats import k_rule_expr, k_rule_of_thumb
from kmstream.functions.vectors import ArrayVec, distance, with_assignment
from kmstream.operators.anomaly import AnomalyDetector
from kmstream.operators.blocks import sweep_lloyd
from kmstream.operators.cluster import assemble, first_rows_init, fit_kmeans, label_counts, lloyd, score_centers
from kmstream.operators.encode import CategoryEncoder, encode_features
from kmstream.operators.reduce import components_for_variance, fit_pca, project_vector
from kmstream.operators.scale import UnitScale, ZScore, column_stats
from kmstream.operators.restarts import fit_restarts
from kmstream.operators.sparse import sparse_lloyd, sparse_rows
from kmstream.operators.score import (cluster_label_count as _clc, entropy_of_counts,
                                      label_entropy as _le, scores_frame, weighted_entropy as _we)
from kmstream.plans import params as P
from kmstream.sources.records import (CATEGORY, LABEL, NUMERIC, TRADE, Layout, last_field,
                                      parse_records, split_fields as _split)
from kmstream.session import scratch_dir, stored
from kmstream.sources.tables import table, text_lines

R6 = P.SCALED_DIGITS
R4 = P.RAW_DIGITS


def _r(c, d=R6):
    return F.round(c, d)


# ------------------------------------------------------------------ inputs

def part_frame(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part")


def part_scaled(spark: SparkSession, sf: str):
    part = part_frame(spark, sf).select(P.PART_KEY, *P.PART_COLS)
    zs = ZScore(P.PART_COLS).fit(part)
    return zs.transform(part), zs


def emb_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings with the float32 vector widened to array<double>."""
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.col("label").cast("long").alias("label"),
                    F.col("embedding").cast("array<double>").alias("emb"))


EMB_X = ArrayVec("emb", P.EMB_DIM)


def emb_centers(emb: DataFrame) -> list[list[float]]:
    return first_rows_init(emb, EMB_X, "vec_id", P.EMB_K)


def emb_assigned(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings under the model fitted from the first rows by id."""
    emb = emb_frame(spark, sf)
    fit = lloyd(emb, EMB_X, {P.EMB_K: emb_centers(emb)}, max_iter=P.LLOYD_ITERS, tol=0.0, score=False)
    return with_assignment(emb, EMB_X, fit[P.EMB_K].centers, "cluster", "dist")


def sweep_k(n: int) -> list[int]:
    """k = 1 .. rule of thumb."""
    return list(range(1, max(1, k_rule_of_thumb(n)) + 1))


ORDERS_LAYOUT = Layout.of([("orderkey", NUMERIC), ("custkey", NUMERIC), ("status", CATEGORY),
                           ("priority", LABEL), ("bucket", NUMERIC), ("tail", CATEGORY)])


def orders_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Comma lines built from integer and text columns of orders, with blanks."""
    o = table(spark, sf, "orders")
    bucket = (F.when(F.col("o_orderstatus") == "P", F.lit(""))
              .when(F.col("o_orderpriority").startswith("1"), F.lit(" \t"))
              .otherwise((F.col("o_custkey") % 10).cast("string")))
    tail = F.when(F.col("o_orderpriority").startswith("5"), F.lit("")).otherwise(F.col("o_orderstatus"))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                       F.col("o_orderstatus"), F.col("o_orderpriority"), bucket, tail)
    return o.select(line.alias("value"))


# ------------------------------------------------------------------ scaling

def q_column_stats(spark, sf):
    part = part_frame(spark, sf)
    s = column_stats(part, P.PART_COLS)
    return s.select("column", F.col("n").cast("long").alias("n"), _r("sum", 2).alias("sum"),
                    _r("sum_sq", 2).alias("sum_sq"), _r("mean").alias("mean"),
                    _r("sd_pop").alias("sd_pop"), _r("sd_samp").alias("sd_samp"))


def q_zscore(spark, sf):
    scaled, _ = part_scaled(spark, sf)
    return scaled.select(P.PART_KEY, _r(F.col("p_size")).alias("z_size"),
                         _r(F.col("p_retailprice")).alias("z_price"))


def q_unit_scale(spark, sf):
    part = part_frame(spark, sf).select(P.PART_KEY, *P.PART_COLS)
    m = UnitScale(P.PART_COLS).fit(part)
    e = m.raw_exprs()
    return part.select(P.PART_KEY, _r(e[0]).alias("u_size"), _r(e[1]).alias("u_price"))


def q_k_estimate(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.agg(F.count(F.lit(1)).alias("n")).select(
        F.col("n").cast("long").alias("n"), k_rule_expr(F.col("n")).alias("k"))


# ------------------------------------------------------------------ categories

def q_category_index(spark, sf):
    part = part_frame(spark, sf)
    model = CategoryEncoder(P.PART_CATS).fit(part)
    return model.dictionary.select("column", "category", F.col("idx").cast("long").alias("idx"))


def q_one_hot(spark, sf):
    part = part_frame(spark, sf)
    model = CategoryEncoder(P.PART_CATS).fit(part)
    rows = model.one_hot(part.select(P.PART_KEY, *P.PART_CATS))
    blocks = [rows.select(P.PART_KEY, F.lit(c).alias("column"), F.posexplode(vector_to_array(F.col(c + "_vec"))).alias("slot", "value"))
              .filter("value <> 0") for c in P.PART_CATS]
    out = blocks[0]
    for b in blocks[1:]:
        out = out.unionByName(b)
    return out.withColumn("slot", F.col("slot").cast("long"))


def q_encoded_features(spark, sf):
    part = part_frame(spark, sf).select(P.PART_KEY, *P.PART_COLS, *P.PART_CATS)
    part = part.withColumn("p_size", F.col("p_size").cast("double"))
    vec, _ = encode_features(part, P.PART_COLS, P.PART_CATS, "features")
    arr = vec.select(P.PART_KEY, vector_to_array(F.col("features")).alias("arr"))
    at = F.filter(F.sequence(F.lit(0), F.size("arr") - 1), lambda i: F.get(F.col("arr"), i) != 0.0)
    return arr.select(
        P.PART_KEY, F.size("arr").cast("long").alias("width"), F.size(at).cast("long").alias("nnz"),
        F.array_join(at.cast("array<string>"), ",").alias("slots"),
        _r(F.sqrt(F.aggregate("arr", F.lit(0.0), lambda acc, x: acc + x * x))).alias("norm"))


# ------------------------------------------------------------------ records

def _parsed_orders(spark, sf):
    return parse_records(orders_lines(spark, sf), ORDERS_LAYOUT, "value")


def q_batch_text_scan(spark, sf):
    """A-1: text files read as one record per line."""
    src = scratch_dir(spark, "orders-text")
    orders_lines(spark, sf).write.text(src)
    return text_lines(spark, src).select(F.col("value").alias("line"))


def q_split_fields(spark, sf):
    f = _split(F.col("value"), ",", ORDERS_LAYOUT.width)
    return orders_lines(spark, sf).select(f.alias("f")).select(
        F.col("f").getItem(0).cast("long").alias("line_key"), F.size("f").cast("long").alias("n_fields"),
        F.col("f").getItem(2).alias("status"), F.col("f").getItem(4).alias("bucket_raw"),
        F.col("f").getItem(5).alias("tail"))


def q_last_field_histogram(spark, sf):
    lines = orders_lines(spark, sf)
    return (lines.groupBy(last_field(F.col("value")).alias("last_field"))
            .agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt")))


def q_blank_to_zero(spark, sf):
    p = _parsed_orders(spark, sf)
    return p.select(F.col("orderkey").cast("long").alias("line_key"), F.col("bucket"))


def q_numeric_features(spark, sf):
    p = _parsed_orders(spark, sf)
    return p.select(*ORDERS_LAYOUT.numeric)


def q_label_features(spark, sf):
    p = _parsed_orders(spark, sf)
    return p.select(F.col(ORDERS_LAYOUT.label).alias("label"), *ORDERS_LAYOUT.numeric)


def trade_lines(spark: SparkSession, sf: str) -> DataFrame:
    """28-field records built from lineitem, with blank numbers and blank categories."""
    li = table(spark, sf, "lineitem")
    text = {"trade_id": F.concat_ws("-", "l_orderkey", "l_linenumber"), "product_type": F.concat("l_returnflag", "l_linestatus"), "buy_sell": F.col("l_returnflag"),
            "audit_action": F.col("l_linestatus"), "trade_date": F.date_format("l_shipdate", "yyyyMMdd"), "quantity": F.col("l_quantity").cast("string"),
            "notional": F.col("l_extendedprice").cast("string"), "trade_mod_date": F.lit("not a number"),
            "sec_amount": F.when(F.col("l_returnflag") == "R", F.lit("\t ")).otherwise(F.col("l_tax").cast("string")),
            "trade_version": F.when(F.col("l_returnflag") == "A", F.lit("")).otherwise(F.col("l_linenumber").cast("string"))}
    fields = [text.get(name, F.lit("")) for name, _ in TRADE.fields]
    return li.select(F.concat(*[x for f in fields for x in (f, F.lit(","))][:-1]).alias("value"))


def q_trade_records(spark, sf):
    """C-1..C-8 on the trade record: typed fields, blank numbers 0, blank categories '', one field dropped."""
    p = parse_records(trade_lines(spark, sf), TRADE, keep_line=False)
    return p.select(F.col("trade_id").alias("label"), "product_type", "buy_sell", "audit_action", "currency", F.col("trade_date").cast("long").alias("trade_date"),
                    "quantity", "notional", "sec_amount", "trade_version", F.lit(len(p.columns)).cast("long").alias("n_columns"))


# ------------------------------------------------------------------ vectors

def q_vector_distance(spark, sf):
    emb = emb_frame(spark, sf)
    first = first_rows_init(emb, EMB_X, "vec_id", 1)[0]
    return emb.select("vec_id", _r(distance(EMB_X, first)).alias("dist"))


def q_assign_nearest(spark, sf):
    """F-4 under given centres: the first rows by id."""
    emb = emb_frame(spark, sf)
    near = with_assignment(emb, EMB_X, emb_centers(emb), "cluster", None)
    return near.select("vec_id", F.col("cluster").cast("long").alias("cluster"))


def q_dist_to_centroid(spark, sf):
    return emb_assigned(spark, sf).select("vec_id", F.col("cluster").cast("long").alias("cluster"),
                                          _r(F.col("dist")).alias("dist"))


def q_mean_distance(spark, sf):
    return emb_assigned(spark, sf).agg(_r(F.avg("dist")).alias("mean_dist")).select(
        F.lit(P.EMB_K).cast("long").alias("k"), "mean_dist")


def q_cluster_label_count(spark, sf):
    c = _clc(emb_assigned(spark, sf))
    return c.select(F.col("cluster").cast("long").alias("cluster"), "label",
                    F.col("cnt").cast("long").alias("cnt"))


def q_label_entropy(spark, sf):
    e = _le(table(spark, sf, "embeddings").select(F.col("label").cast("long").alias("label")))
    return e.select(_r(F.col("entropy")).alias("entropy"), F.col("n").cast("long").alias("n"))


def q_weighted_entropy(spark, sf):
    return _we(emb_assigned(spark, sf)).select(_r(F.col("score")).alias("score"))


# ------------------------------------------------------------------ fixed-start Lloyd on part

def _part_lloyd(spark, sf, scaled: bool, k: int | None = None):
    """Fits from the first rows by key: the model of ``k``, or of every k up to the rule of thumb."""
    if scaled:
        data, zs = part_scaled(spark, sf)
        n = zs.n
    else:
        data = part_frame(spark, sf).select(P.PART_KEY, *[F.col(c).cast("double").alias(c)
                                                            for c in P.PART_COLS])
        n = data.count() if k is None else 0
    ks = sweep_k(n) if k is None else [k]
    starts = first_rows_init(data, P.PART_COLS, P.PART_KEY, max(ks))
    fit = lloyd if len(ks) == 1 else sweep_lloyd
    res = fit(data, P.PART_COLS, {j: starts[:j] for j in ks}, max_iter=P.LLOYD_ITERS, tol=0.0)
    return data, res


def _centers_frame(spark, centers, key_col="cluster"):
    """The k centres of a model as a small DataFrame (k rows, model output)."""
    rows = [(j, [float(v) for v in c]) for j, c in enumerate(centers)]
    return spark.createDataFrame(rows, f"{key_col} long, center array<double>")


def q_lloyd_fixed_init(spark, sf):
    """Centres and sizes: both come from the fit's own scans."""
    _, res = _part_lloyd(spark, sf, False, P.LLOYD_K)
    fit = res[P.LLOYD_K]
    rows = [(j, float(c[0]), float(c[1]), int(n)) for j, (c, n) in enumerate(zip(fit.centers, fit.sizes))]
    out = spark.createDataFrame(rows, "cluster long, c_size double, c_price double, n long")
    return out.select("cluster", _r(F.col("c_size"), R4).alias("c_size"), _r(F.col("c_price"), R4).alias("c_price"), "n")


def q_centers_csv(spark, sf):
    _, res = _part_lloyd(spark, sf, False, P.LLOYD_K)
    cf = _centers_frame(spark, res[P.LLOYD_K].centers)
    ints = F.transform(F.col("center"), lambda v: F.round(v).cast("long").cast("string"))
    return cf.select(F.col("cluster").cast("long").alias("cluster"),
                     F.array_join(ints, ",").alias("center_csv"))


def _elbow(spark, sf, scaled):
    _, res = _part_lloyd(spark, sf, scaled)
    return scores_frame(spark, res).select("k", _r(F.col("score")).alias("score"))


def q_elbow_scores(spark, sf):
    return _elbow(spark, sf, False)


def q_elbow_scores_scaled(spark, sf):
    return _elbow(spark, sf, True)


def q_scatter_points(spark, sf):
    data, res = _part_lloyd(spark, sf, True, P.LLOYD_K)
    centers = res[P.LLOYD_K].centers
    rows = with_assignment(data, [F.col(c) for c in P.PART_COLS], centers, "cluster", None).select(
        F.lit("row").alias("kind"), F.col(P.PART_KEY).alias("id"), _r(F.col("p_size")).alias("x"),
        _r(F.col("p_retailprice")).alias("y"), F.col("cluster").cast("long").alias("cluster"))
    cents = _centers_frame(spark, centers).select(
        F.lit("centre").alias("kind"), F.col("cluster").alias("id"),
        _r(F.col("center").getItem(0)).alias("x"), _r(F.col("center").getItem(1)).alias("y"),
        F.col("cluster").cast("long").alias("cluster"))
    return rows.unionByName(cents)


# ------------------------------------------------------------------ anomalies

def part_anomaly_model(spark, sf):
    part = part_frame(spark, sf).select(P.PART_KEY, *P.PART_COLS)
    det = AnomalyDetector(P.PART_COLS, k=P.LLOYD_K, n_top=P.N_TOP, init="fixed",
                          order_by=P.PART_KEY, max_iter=P.LLOYD_ITERS, tol=0.0)
    return part, det.fit(part)


def q_topn_threshold(spark, sf):
    part, model = part_anomaly_model(spark, sf)
    flagged = model.transform(part)
    # threshold recomputed as a DataFrame (top-N then min) so the query stays lazy
    top = flagged.select("dist").orderBy(F.desc("dist")).limit(P.N_TOP)
    return top.agg(_r(F.min("dist")).alias("threshold"))


def q_anomaly_flags(spark, sf):
    part, model = part_anomaly_model(spark, sf)
    return model.transform(part).select(P.PART_KEY, F.col("cluster").cast("long").alias("cluster"),
                                        _r(F.col("dist")).alias("dist"), "is_anomaly")


def q_anomaly_rows(spark, sf):
    part, model = part_anomaly_model(spark, sf)
    return (model.transform(part).where(F.col("is_anomaly"))
            .select(P.PART_KEY, F.col("cluster").cast("long").alias("cluster"),
                    _r(F.col("dist")).alias("dist")))


# ------------------------------------------------------------------ PCA

def q_pca_2d(spark, sf):
    part = part_frame(spark, sf).select(P.PART_KEY, *[F.col(c).cast("double").alias(c)
                                                        for c in P.PART_COLS])
    res = fit_pca(part, P.PART_COLS, 2)
    pcs = res.project_exprs(P.PART_COLS)
    return part.select(P.PART_KEY, _r(pcs[0], R4).alias("pc1"), _r(pcs[1], R4).alias("pc2"))


def q_explained_variance(spark, sf):
    part = part_frame(spark, sf).select(*[F.col(c).cast("double").alias(c) for c in P.PART_COLS])
    res = fit_pca(part, P.PART_COLS, 2)
    ev = res.explained_variance
    rows = [(i + 1, float(v), float(sum(ev[: i + 1]))) for i, v in enumerate(ev)]
    df = spark.createDataFrame(rows, "component long, ratio double, cumulative double")
    return df.select("component", _r(F.col("ratio")).alias("ratio"),
                     _r(F.col("cumulative")).alias("cumulative"))


def q_components_for_variance(spark, sf):
    """E-6: how many components reach a share of the variance, for raw and z-scored columns."""
    raw = part_frame(spark, sf).select(*[F.col(c).cast("double").alias(c) for c in P.PART_COLS])
    scaled, _ = part_scaled(spark, sf)
    rows = [(name, t, components_for_variance(fit_pca(df, P.PART_COLS, 2).explained_variance, t))
            for name, df in (("raw", raw), ("scaled", scaled)) for t in P.VARIANCE_TARGETS]
    return spark.createDataFrame(rows, "columns string, target double, m long")


def q_pca_chosen_components(spark, sf):
    """E-6 on encoded rows: the m chosen for 0.91 of the variance keeps that share in the projection, and m - 1 does not."""
    vec, model = _encoded_part(spark, sf)
    width = len(P.PART_COLS) + sum(model.sizes.values())
    whole = fit_pca(vec, None, width, features_col="features")
    m = components_for_variance(whole.explained_variance, P.VARIANCE_TARGETS[1])
    out = project_vector(vec, whole, "features", "pca")
    kept = out.agg(*[F.var_pop(F.col("pca").getItem(j)).alias(f"v{j}") for j in range(width)], F.count(F.lit(1)).alias("n")).first()
    share = [sum(kept[:k]) / sum(kept[:width]) for k in (m, m - 1)]
    row = (int(kept["n"]), width, share[0] >= P.VARIANCE_TARGETS[1] - 1e-9, share[1] < P.VARIANCE_TARGETS[1])
    return spark.createDataFrame([row], "n long, width long, reached boolean, least boolean")


# ------------------------------------------------------------------ Kafka decode (static frame)

def kafka_frame(spark, sf) -> DataFrame:
    """Static stand-in for a Kafka batch: (key BINARY, value BINARY) from events."""
    ev = table(spark, sf, "events")
    line = F.concat_ws(",", F.col("event_id").cast("string"), F.col("user_id").cast("string"),
                       F.col("event_type"))
    return ev.select(F.col("event_id").cast("string").cast("binary").alias("key"),
                     line.cast("binary").alias("value"))


def q_kafka_value_decode(spark, sf):
    from kmstream.sources.streams import decode_kafka_value
    lines = decode_kafka_value(kafka_frame(spark, sf))
    f = F.split(F.col("value"), ",", 3)
    return lines.select(f.getItem(0).cast("long").alias("event_id"),
                        f.getItem(1).cast("long").alias("user_id"),
                        f.getItem(2).alias("event_type"), F.col("value").alias("line"))


# ------------------------------------------------------------------ default clustering report (F-18)

def q_default_report(spark, sf):
    """F-18 in one piece: fit, centres, label counts under the fitted model."""
    emb = emb_frame(spark, sf)
    fit = lloyd(emb, EMB_X, {P.EMB_K: emb_centers(emb)}, max_iter=P.LLOYD_ITERS, tol=0.0)
    counts = label_counts(emb, EMB_X, {P.EMB_K: fit[P.EMB_K].centers}, "label")
    centers = _centers_frame(spark, fit[P.EMB_K].centers)
    return counts.join(centers, "cluster").select(
        "cluster", F.col("label").cast("long").alias("label"), "cnt", _r(F.col("center").getItem(0)).alias("c0"),
        _r(F.col("center").getItem(P.EMB_DIM - 1)).alias("c63"))


# ------------------------------------------------------------------ incomplete rows

def _part_holes(spark, sf):
    """part with p_size missing for every tenth key and p_retailprice NaN for every thirteenth."""
    return part_frame(spark, sf).select(
        P.PART_KEY, F.when(F.col(P.PART_KEY) % 10 != 0, F.col("p_size").cast("double")).alias("p_size"),
        F.when(F.col(P.PART_KEY) % 13 == 0, F.lit(float("nan"))).otherwise(F.col("p_retailprice")).alias("p_retailprice"))


def q_lloyd_incomplete_rows(spark, sf):
    """Fit and prediction with null and NaN features: such rows train nothing and have no cluster."""
    data = _part_holes(spark, sf)
    starts = first_rows_init(data, P.PART_COLS, P.PART_KEY, P.LLOYD_K)
    fit = lloyd(data, P.PART_COLS, {P.LLOYD_K: starts}, max_iter=P.LLOYD_ITERS, tol=0.0, score=False)[P.LLOYD_K]
    near = with_assignment(data, [F.col(c) for c in P.PART_COLS], fit.centers, "cluster", "dist")
    none = F.lit(-1)   # in place of null, which the comparison's tools type differently
    return near.select(P.PART_KEY, F.coalesce(F.col("cluster"), none).cast("long").alias("cluster"),
                       F.coalesce(_r(F.col("dist"), R4), none.cast("double")).alias("dist"))


def q_category_null_unseen(spark, sf):
    """D-4: a dictionary fitted on even keys, with null categories, applied to all rows (unseen: its size)."""
    part = part_frame(spark, sf).select(P.PART_KEY, F.when(F.col(P.PART_KEY) % 7 != 0, F.col("p_type")).alias("p_type"))
    model = CategoryEncoder(["p_type"]).fit(part.filter(F.col(P.PART_KEY) % 16 == 0))
    out = model.index(part, handle_invalid="keep")
    return out.select(P.PART_KEY, F.col("p_type_idx").cast("long").alias("slot"))


# ------------------------------------------------------------------ label encoded: sparse rows

def _sparse_part(spark, sf):
    part = part_frame(spark, sf).select(P.PART_KEY, *P.PART_COLS, *P.PART_CATS)
    zs = ZScore(P.PART_COLS).fit(part)
    scaled = part.select(P.PART_KEY, *P.PART_CATS, F.col(P.PART_KEY).cast("string").alias("label"), *zs.exprs())
    return sparse_rows(scaled, P.PART_KEY, P.PART_COLS, P.PART_CATS, "label", include_label=True)


def q_sparse_label_rows(spark, sf):
    """C-8 / D-2 with the label encoded: width (it grows with the table), filled slots, place of the label's slot and length per row."""
    rows = _sparse_part(spark, sf)
    each = rows.entries.groupBy("id").agg(F.count(F.lit(1)).alias("slots"), F.max("slot").alias("label_slot"))
    return rows.norms.join(each, "id").select(F.col("id").alias(P.PART_KEY), F.lit(rows.width).cast("long").alias("width"), "slots", "label_slot",
                                              _r(F.col("norm2"), R4).alias("norm2"))


def q_sparse_lloyd_update(spark, sf):
    """F-2 on label-encoded rows: one update from the first rows; per cluster its filled slots and squared length."""
    centers = sparse_lloyd(_sparse_part(spark, sf), P.LLOYD_K, updates=1)
    return centers.filter("value <> 0").groupBy("cluster").agg(F.count(F.lit(1)).alias("slots"), _r(F.sum(F.col("value") * F.col("value")), R4).alias("norm2"))


# ------------------------------------------------------------------ random starts: facts that hold for any start

def _restart_facts(spark, data: DataFrame, cols, fits: dict, single: dict) -> DataFrame:
    """Per k: rows scored; one more update does not raise the cost; the best run is no worse than a single one; sizes add up."""
    again = sweep_lloyd(data, cols, {k: f.centers for k, f in fits.items()}, max_iter=1, tol=0.0)
    rows = []
    for k, f in sorted(fits.items()):
        rows.append((int(k), int(f.n), bool(again[k].cost <= f.cost * (1 + 1e-9) + 1e-9),
                     bool(f.cost <= single[k].cost * (1 + 1e-9) + 1e-9), sum(f.sizes) == f.n))
    return spark.createDataFrame(rows, "k long, n long, monotone boolean, best boolean, complete boolean")


def _facts(spark, data, cols, n: int, seed: int) -> DataFrame:
    ks = sweep_k(n)
    best = fit_restarts(data, cols, ks, runs=P.RESTARTS, tol=P.RESTART_TOL, max_iter=40, seed=seed)
    one = fit_restarts(data, cols, ks, runs=1, tol=P.RESTART_TOL, max_iter=40, seed=seed)
    return _restart_facts(spark, data, cols, best, one)


def q_kmeans_restarts(spark, sf):
    """F-15: best of 10 k-means|| starts (tol 1e-6) for every k up to the rule of thumb, z-scored part.

    All runs of all k share every scan; scores and costs are the fit's own."""
    data, zs = part_scaled(spark, sf)
    best = fit_restarts(data, P.PART_COLS, sweep_k(zs.n), runs=P.RESTARTS, tol=P.RESTART_TOL, max_iter=20, seed=7)
    return scores_frame(spark, best).select("k", "score", "cost")


def q_restart_facts_scaled(spark, sf):
    """F-3 / F-9 / F-15: facts that hold whatever the random starts."""
    data, zs = part_scaled(spark, sf)
    return _facts(spark, data, P.PART_COLS, zs.n, 7)


def q_restart_facts_raw(spark, sf):
    """F-14: the same sweep on raw columns."""
    data = part_frame(spark, sf).select(*[F.col(c).cast("double").alias(c) for c in P.PART_COLS])
    return _facts(spark, data, P.PART_COLS, data.count(), 9)


def q_kmeans_fit(spark, sf):
    """F-1: library defaults (k=2, maxIter 20, tol 1e-4) on raw lineitem numerics."""
    li = table(spark, sf, "lineitem").select(*P.LINEITEM_COLS)
    res = _library_fit(li)
    scored = score_centers(li, P.LINEITEM_COLS, {2: res.centers})[2]
    rows = [(j, n) for j, n in enumerate(scored.sizes)]
    return spark.createDataFrame(rows, "cluster long, n long").withColumn("mean_dist", F.lit(scored.mean_distance))


def _library_fit(li):
    # several splits are dealt into parts of even size, whatever row groups the files have; one split is small enough
    even = li.hint("rebalance") if li.rdd.getNumPartitions() > 1 else li
    feats = assemble(even, P.LINEITEM_COLS).cache()
    try:
        return fit_kmeans(feats, 2, seed=1)
    finally:
        feats.unpersist()


def q_kmeans_fit_facts(spark, sf):
    """F-1: every row is in one of the two clusters, and one more update does not raise the cost."""
    li = table(spark, sf, "lineitem").select(*P.LINEITEM_COLS)
    res = _library_fit(li)
    here = score_centers(li, P.LINEITEM_COLS, {2: res.centers})[2]
    next_ = lloyd(li, P.LINEITEM_COLS, {2: res.centers}, max_iter=1, tol=0.0)[2]
    row = (2, here.n, len(res.centers) == 2 and min(here.sizes) > 0, next_.cost <= here.cost * (1 + 1e-9))
    return spark.createDataFrame([row], "k long, n long, both_used boolean, monotone boolean")


def _lineitem_detector(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *P.LINEITEM_COLS)
    det = AnomalyDetector(P.LINEITEM_COLS, k=None, n_top=P.N_TOP, init="k-means||", runs=P.RESTARTS, tol=P.RESTART_TOL, max_iter=20)
    return li, det.fit(li)


def q_lineitem_anomalies(spark, sf):
    """F-22 at table scale: z-score, k by rule of thumb, ten starts, top-100 threshold."""
    li, model = _lineitem_detector(spark, sf)
    return (model.transform(li).where(F.col("is_anomaly"))
            .select("l_orderkey", "l_linenumber", F.col("cluster").cast("long").alias("cluster"),
                    F.col("dist")))


def q_lineitem_anomaly_facts(spark, sf):
    """F-21 / F-22: k follows the rule, every row has a cluster, fewer than N rows lie above the N-th largest distance."""
    li, model = _lineitem_detector(spark, sf)
    out = model.transform(li).agg(F.count(F.lit(1)).alias("n"), F.count("cluster").alias("assigned"),
                                  F.count_if(F.col("is_anomaly")).alias("above"), F.count_if(F.col("dist") >= model.threshold).alias("top"))
    return out.select(F.lit(len(model.centers)).cast("long").alias("k"), "n", (F.col("n") == F.col("assigned")).alias("all_assigned"),
                      (F.col("above") < P.N_TOP).alias("fewer_above"), (F.col("top") >= F.least(F.lit(P.N_TOP), "n")).alias("n_at_least"))


# ------------------------------------------------------------------ PCA of encoded rows

def _encoded_part(spark, sf):
    part = part_frame(spark, sf).select(P.PART_KEY, *P.PART_COLS, *P.PART_CATS)
    return encode_features(part.withColumn("p_size", F.col("p_size").cast("double")), P.PART_COLS, P.PART_CATS, "features")


def q_pca_project(spark, sf):
    """E-4 on encoded part rows (numerics + one-hot brand/type)."""
    vec, _ = _encoded_part(spark, sf)
    res = fit_pca(vec, None, P.PCA_M, features_col="features")
    out = project_vector(vec, res, "features", "pca")
    return out.select(P.PART_KEY, *[F.col("pca").getItem(j).alias(f"pc{j + 1}") for j in range(P.PCA_M)])


def q_pca_zscore(spark, sf):
    """E-5: PCA projection then population z-score of the projection."""
    proj = q_pca_project(spark, sf)
    zs = ZScore([f"pc{j + 1}" for j in range(P.PCA_M)]).fit(proj)
    return zs.transform(proj)


def q_pca_norms(spark, sf):
    """E-4: with all components the projection of an encoded row keeps its length (loadings complete and orthonormal)."""
    vec, model = _encoded_part(spark, sf)
    width = len(P.PART_COLS) + sum(model.sizes.values())
    out = project_vector(vec, fit_pca(vec, None, width, features_col="features"), "features", "pca")
    return out.select(P.PART_KEY, F.round(F.sqrt(F.aggregate("pca", F.lit(0.0), lambda a, x: a + x * x)), 4).alias("norm"))


def q_pca_mahalanobis(spark, sf):
    """E-5: the squared length of the z-scored full projection is the squared Mahalanobis distance to the mean."""
    part = part_frame(spark, sf).select(P.PART_KEY, *[F.col(c).cast("double").alias(c) for c in P.PART_COLS])
    names = ["pc1", "pc2"]
    proj = part.select(P.PART_KEY, *fit_pca(part, P.PART_COLS, 2).project_exprs(P.PART_COLS))
    z = ZScore(names).fit(proj).transform(proj)
    return z.select(P.PART_KEY, _r(F.col("pc1") * F.col("pc1") + F.col("pc2") * F.col("pc2"), R4).alias("d2"))


def q_entropy_sweep(spark, sf):
    """F-17: weighted label entropy for every k up to the rule of thumb (fixed starts, shared scans)."""
    emb = emb_frame(spark, sf)
    ks = sweep_k(emb.count())
    starts = first_rows_init(emb, EMB_X, "vec_id", max(ks))
    res = sweep_lloyd(emb, EMB_X, {k: starts[:k] for k in ks}, max_iter=P.LLOYD_ITERS, tol=0.0, score=False)
    return _entropies(label_counts(emb, EMB_X, {k: r.centers for k, r in res.items()}, "label"))


def _entropies(counts: DataFrame) -> DataFrame:
    ent = entropy_of_counts(counts, ["k", "cluster"])
    return ent.groupBy("k").agg(_r(F.sum(F.col("n") * F.col("entropy")) / F.sum("n")).alias("score"))


def _encoded_scaled(spark, sf):
    """Encoded part rows under the population z-score: (frame with ``arr``, vector, rows)."""
    from pyspark.ml.feature import StandardScaler
    vec, model = _encoded_part(spark, sf)
    width = len(P.PART_COLS) + sum(model.sizes.values())
    n = vec.count()
    grow = (n / (n - 1)) ** 0.5 if n > 1 else 1.0   # the library divides by the sample deviation
    scaled = (StandardScaler(withMean=True, withStd=True, inputCol="features", outputCol="z").fit(vec).transform(vec)
              .select(F.transform(vector_to_array(F.col("z")), lambda x: x * F.lit(grow)).alias("arr")))
    return scaled, ArrayVec("arr", width), n


def q_elbow_scores_encoded(spark, sf):
    """F-16: encoded + z-scored part rows, best of 10 k-means|| runs for every k up to the rule of thumb."""
    data, x, n = _encoded_scaled(spark, sf)
    best = fit_restarts(data, x, sweep_k(n), runs=P.RESTARTS, tol=P.RESTART_TOL, seed=11)
    return scores_frame(spark, best).select("k", "score", "cost")


def q_elbow_encoded_k1(spark, sf):
    """F-16 at k = 1, where the model is the mean: the cost of population z-scores is rows x columns that vary."""
    data, x, n = _encoded_scaled(spark, sf)
    fit = fit_restarts(data, x, [1], runs=1)[1]
    return spark.createDataFrame([(1, fit.n, float(fit.cost))], "k long, n long, cost double").select("k", "n", _r(F.col("cost"), 3).alias("cost"))


def _record_features(spark, sf):
    """orders lines -> parse (blank rule) -> one-hot categories + numerics -> PCA -> z-score; the line stays."""
    from kmstream.streaming.prepare import FrozenFeatures
    # read by every step below, whose filters would parse each line many times over: written once
    parsed, _ = stored(spark, _parsed_orders(spark, sf), "records")
    feats = FrozenFeatures(ORDERS_LAYOUT.numeric, ORDERS_LAYOUT.categorical, P.PCA_M).fit(parsed)
    return feats.transform(parsed), feats


def _record_model(spark, sf, k: int = P.LLOYD_K):
    prepared, feats = _record_features(spark, sf)
    det = AnomalyDetector(feats.cols, k=k, n_top=P.N_TOP, normalize=False, init="k-means||",
                          runs=P.RESTARTS, tol=P.RESTART_TOL)
    model = det.fit(prepared)
    return model.transform(prepared), model


def q_record_anomalies(spark, sf):
    """F-22 end to end on delimited records (C-10: the original line stays beside its vector)."""
    out, _ = _record_model(spark, sf)
    return out.where(F.col("is_anomaly")).select(F.col("value").alias("line"), F.col("cluster").cast("long").alias("cluster"), F.col("dist"))


def q_record_anomaly_facts(spark, sf):
    """F-22: every line is scored, fewer than N lie above the N-th largest distance, and at least N at or above it."""
    out, model = _record_model(spark, sf)
    seen = out.agg(F.count("cluster").alias("n"), F.count_if(F.col("is_anomaly")).alias("above"), F.count_if(F.col("dist") >= model.threshold).alias("top"),
                   F.count_if(F.col("value").isNotNull()).alias("lines"))
    return seen.select("n", "lines", (F.col("above") < P.N_TOP).alias("fewer_above"), (F.col("top") >= F.least(F.lit(P.N_TOP), "n")).alias("n_at_least"))


def q_record_anomalies_many(spark, sf):
    """F-21 / F-22 with an explicit k = 150 on the PCA features: clusters in use, rows scored, fewer than N above the threshold."""
    out, model = _record_model(spark, sf, P.RECORD_K)
    seen = out.agg(F.count("cluster").alias("n"), F.countDistinct("cluster").alias("used"), F.count_if(F.col("is_anomaly")).alias("above"))
    return seen.select(F.lit(len(model.centers)).cast("long").alias("k"), "n", (F.col("used") <= P.RECORD_K).alias("within_k"),
                       (F.col("above") < P.N_TOP).alias("fewer_above"))


def q_entropy_sweep_encoded(spark, sf):
    """F-17 as composed: encode -> PCA -> z-score -> per k (10 starts) -> size-weighted label entropy."""
    prepared, feats = _record_features(spark, sf)
    best = fit_restarts(prepared, feats.cols, sweep_k(feats.zscore.n), runs=P.RESTARTS, tol=P.RESTART_TOL)
    return _entropies(label_counts(prepared, feats.cols, {k: r.centers for k, r in best.items()}, "priority"))


def q_entropy_encoded_k1(spark, sf):
    """F-17 at k = 1: the weighted entropy is that of the labels."""
    prepared, feats = _record_features(spark, sf)
    fit = fit_restarts(prepared, feats.cols, [1], runs=1)
    return _entropies(label_counts(prepared, feats.cols, {1: fit[1].centers}, "priority"))


QUERIES = {
    "column_stats": q_column_stats,
    "zscore": q_zscore,
    "unit_scale": q_unit_scale,
    "k_estimate": q_k_estimate,
    "category_index": q_category_index,
    "one_hot": q_one_hot,
    "encoded_features": q_encoded_features,
    "batch_text_scan": q_batch_text_scan,
    "components_for_variance": q_components_for_variance,
    "pca_chosen_components": q_pca_chosen_components,
    "record_anomalies_many": q_record_anomalies_many,
    "split_fields": q_split_fields,
    "last_field_histogram": q_last_field_histogram,
    "blank_to_zero": q_blank_to_zero,
    "numeric_features": q_numeric_features,
    "label_features": q_label_features,
    "trade_records": q_trade_records,
    "vector_distance": q_vector_distance,
    "assign_nearest": q_assign_nearest,
    "dist_to_centroid": q_dist_to_centroid,
    "mean_distance": q_mean_distance,
    "cluster_label_count": q_cluster_label_count,
    "label_entropy": q_label_entropy,
    "weighted_entropy": q_weighted_entropy,
    "lloyd_fixed_init": q_lloyd_fixed_init,
    "centers_csv": q_centers_csv,
    "elbow_scores": q_elbow_scores,
    "elbow_scores_scaled": q_elbow_scores_scaled,
    "scatter_points": q_scatter_points,
    "topn_threshold": q_topn_threshold,
    "anomaly_flags": q_anomaly_flags,
    "anomaly_rows": q_anomaly_rows,
    "pca_2d": q_pca_2d,
    "explained_variance": q_explained_variance,
    "kafka_value_decode": q_kafka_value_decode,
    "entropy_sweep": q_entropy_sweep,
    "default_report": q_default_report,
    "lloyd_incomplete_rows": q_lloyd_incomplete_rows,
    "category_null_unseen": q_category_null_unseen,
    "restart_facts_scaled": q_restart_facts_scaled,
    "restart_facts_raw": q_restart_facts_raw,
    "sparse_label_rows": q_sparse_label_rows,
    "sparse_lloyd_update": q_sparse_lloyd_update,
    "kmeans_fit_facts": q_kmeans_fit_facts,
    "lineitem_anomaly_facts": q_lineitem_anomaly_facts,
    "pca_norms": q_pca_norms,
    "pca_mahalanobis": q_pca_mahalanobis,
    "elbow_encoded_k1": q_elbow_encoded_k1,
    "record_anomaly_facts": q_record_anomaly_facts,
    "entropy_encoded_k1": q_entropy_encoded_k1,
    # random starts, library numerics: rows only; the *_facts, pca_* and *_k1 queries above hold their parts against SQL
    "kmeans_restarts": q_kmeans_restarts,
    "kmeans_fit": q_kmeans_fit,
    "lineitem_anomalies": q_lineitem_anomalies,
    "pca_project": q_pca_project,
    "pca_zscore": q_pca_zscore,
    "elbow_scores_encoded": q_elbow_scores_encoded,
    "record_anomalies": q_record_anomalies,
    "entropy_sweep_encoded": q_entropy_sweep_encoded,
}

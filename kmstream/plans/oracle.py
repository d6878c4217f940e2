"""DuckDB SQL oracles for the registered queries.

Each string runs on the pre-registered test-table views and must yield the
same columns, types and (rounded) values as the Spark query of the same
name. Iterative parts (fixed-start Lloyd, the decayed stream replay) are
written as chained or recursive CTEs generated from the shared parameters.
"""

from __future__ import annotations

from kmstream.plans import params as P


def _xs(d: int, alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return ", ".join(f"{a}x{i}" for i in range(d))


def _d2(d: int, p: str = "p", c: str = "c") -> str:
    return " + ".join(f"({p}.x{i} - {c}.x{i}) * ({p}.x{i} - {c}.x{i})" for i in range(d))


def part_points(scaled: bool) -> str:
    """CTE body list producing ``pts(id, x0, x1)`` from part."""
    if not scaled:
        return ("pts AS (SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS x0, "
                "CAST(p_retailprice AS DOUBLE) AS x1 FROM part)")
    return (
        "pstats AS (SELECT avg(CAST(p_size AS DOUBLE)) AS m0, stddev_pop(CAST(p_size AS DOUBLE)) AS s0, "
        "avg(CAST(p_retailprice AS DOUBLE)) AS m1, stddev_pop(CAST(p_retailprice AS DOUBLE)) AS s1 FROM part), "
        "pts AS (SELECT p_partkey AS id, "
        "CASE WHEN s0 <= 0 THEN CAST(p_size AS DOUBLE) - m0 ELSE (CAST(p_size AS DOUBLE) - m0) / s0 END AS x0, "
        "CASE WHEN s1 <= 0 THEN CAST(p_retailprice AS DOUBLE) - m1 ELSE (CAST(p_retailprice AS DOUBLE) - m1) / s1 END AS x1 "
        "FROM part, pstats)")


def rule_k(src: str) -> str:
    """SQL list 1 .. rule-of-thumb k of a table's row count."""
    return f"range(1, greatest(1, CAST(floor(sqrt((SELECT count(*) FROM {src}) // 2)) AS BIGINT)) + 1)"


def lloyd_ctes(d: int, k_list: str, iters: int) -> str:
    """Fixed-start Lloyd over CTE ``pts`` for every k of a SQL list.

    Starts: first k rows by id. Ties in assignment go to the lowest cluster
    id. Empty clusters keep their centre. Every step is MATERIALIZED and the
    start filter uses the 1-based ``row_number()`` directly: DuckDB 2.0 drops
    rows for a filter on ``row_number() - 1`` inside such a chain. Produces ``c<iters>`` (final
    centres) and ``fin`` (final assignment with squared distance ``d2``).
    """
    xs = _xs(d)
    d2 = _d2(d)
    parts = [
        f"ks AS (SELECT unnest({k_list}) AS k)",
        f"rk AS MATERIALIZED (SELECT row_number() OVER (ORDER BY id) AS rn, id, {xs} FROM pts)",
        f"c0 AS MATERIALIZED (SELECT ks.k, rk.rn - 1 AS cluster, {_xs(d, 'rk')} FROM ks JOIN rk ON rk.rn <= ks.k)",
    ]

    def assign(src: str, name: str) -> str:
        return (f"{name} AS MATERIALIZED (SELECT n.k, n.id, n.best.cluster AS cluster, n.best.d2 AS d2, {_xs(d, 'p')} FROM ("
                f"SELECT c.k, p.id, min(struct_pack(d2 := {d2}, cluster := c.cluster)) AS best "
                f"FROM pts p JOIN {src} c ON TRUE GROUP BY c.k, p.id) n JOIN pts p USING (id))")

    for t in range(1, iters + 1):
        parts.append(assign(f"c{t - 1}", f"a{t}"))
        means = ", ".join(f"sum(x{i}) / count(*) AS x{i}" for i in range(d))
        parts.append(f"m{t} AS MATERIALIZED (SELECT k, cluster, {means} FROM a{t} GROUP BY k, cluster)")
        co = ", ".join(f"coalesce(m.x{i}, c.x{i}) AS x{i}" for i in range(d))
        parts.append(f"c{t} AS MATERIALIZED (SELECT c.k, c.cluster, {co} FROM c{t - 1} c "
                     f"LEFT JOIN m{t} m ON m.k = c.k AND m.cluster = c.cluster)")
    parts.append(assign(f"c{iters}", "fin"))
    return ", ".join(parts)


def grouped_lloyd_ctes(d: int, k: int, iters: int) -> str:
    """Fixed-start Lloyd run separately inside every group ``g`` of ``pts(g, id, x..)``.

    Starts are the first k rows of each group by id; produces ``fin``
    (g, id, cluster, d2) under the final centres of the row's own group.
    """
    xs = _xs(d)
    d2 = _d2(d)
    parts = [
        f"rk AS MATERIALIZED (SELECT g, row_number() OVER (PARTITION BY g ORDER BY id) AS rn, id, {xs} FROM pts)",
        f"c0 AS MATERIALIZED (SELECT g, rn - 1 AS cluster, {xs} FROM rk WHERE rn <= {k})",
    ]

    def assign(src: str, name: str) -> str:
        return (f"{name} AS MATERIALIZED (SELECT g, id, cluster, d2, {xs} FROM ("
                f"SELECT p.g, p.id, c.cluster, {d2} AS d2, {_xs(d, 'p')}, "
                f"row_number() OVER (PARTITION BY p.g, p.id ORDER BY {d2}, c.cluster) AS r "
                f"FROM pts p JOIN {src} c ON c.g = p.g) WHERE r = 1)")

    for t in range(1, iters + 1):
        parts.append(assign(f"c{t - 1}", f"a{t}"))
        means = ", ".join(f"sum(x{i}) / count(*) AS x{i}" for i in range(d))
        parts.append(f"m{t} AS MATERIALIZED (SELECT g, cluster, {means} FROM a{t} GROUP BY g, cluster)")
        co = ", ".join(f"coalesce(m.x{i}, c.x{i}) AS x{i}" for i in range(d))
        parts.append(f"c{t} AS MATERIALIZED (SELECT c.g, c.cluster, {co} FROM c{t - 1} c "
                     f"LEFT JOIN m{t} m ON m.g = c.g AND m.cluster = c.cluster)")
    parts.append(assign(f"c{iters}", "fin"))
    return ", ".join(parts)


def emb_points() -> str:
    xs = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i}" for i in range(P.EMB_DIM))
    return (f"pts AS (SELECT vec_id AS id, CAST(label AS BIGINT) AS label, {xs} FROM embeddings), "
            f"cen AS (SELECT row_number() OVER (ORDER BY id) - 1 AS cluster, {_xs(P.EMB_DIM)} "
            f"FROM pts ORDER BY id LIMIT {P.EMB_K}), "
            f"asg0 AS (SELECT id, label, cluster, d2 FROM ("
            f"SELECT p.id, p.label, c.cluster, {_d2(P.EMB_DIM)} AS d2, "
            f"row_number() OVER (PARTITION BY p.id ORDER BY {_d2(P.EMB_DIM)}, c.cluster) AS r "
            f"FROM pts p JOIN cen c ON TRUE) WHERE r = 1)")


def emb_fitted() -> str:
    """``asg``: labels and clusters under the model fitted from the first rows."""
    return emb_points() + ", " + lloyd_ctes(P.EMB_DIM, f"[{P.EMB_K}]", P.LLOYD_ITERS) + (
        ", asg AS (SELECT fin.id, pts.label, fin.cluster, fin.d2 FROM fin JOIN pts USING (id))")


ORDERS_LINE = (
    "lines AS (SELECT o_orderkey, concat_ws(',', CAST(o_orderkey AS VARCHAR), "
    "CAST(o_custkey AS VARCHAR), o_orderstatus, o_orderpriority, "
    "CASE WHEN o_orderstatus = 'P' THEN '' WHEN o_orderpriority LIKE '1%' THEN ' ' || chr(9) "
    "ELSE CAST(o_custkey % 10 AS VARCHAR) END, "
    "CASE WHEN o_orderpriority LIKE '5%' THEN '' ELSE o_orderstatus END) AS line FROM orders), "
    "fl AS (SELECT o_orderkey, line, string_split(line, ',') AS f FROM lines)")


def _b2z(e: str) -> str:
    t = f"regexp_replace({e}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"
    return f"CASE WHEN {t} = '' THEN 0.0 ELSE CAST({t} AS DOUBLE) END"


def _lloyd_part(scaled: bool, k_list: str) -> str:
    return "WITH " + part_points(scaled) + ", " + lloyd_ctes(2, k_list, P.LLOYD_ITERS)


def _anomaly_base() -> str:
    k = P.LLOYD_K
    return (_lloyd_part(True, f"[{k}]") +
            f", thr AS (SELECT min(dist) AS threshold FROM "
            f"(SELECT sqrt(d2) AS dist FROM fin ORDER BY dist DESC LIMIT {P.N_TOP}))")


def _stream_days() -> str:
    return ("ev AS (SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(value AS DOUBLE) AS x0 "
            "FROM events), "
            "days AS (SELECT day, row_number() OVER (ORDER BY day) AS b FROM "
            "(SELECT DISTINCT day FROM ev)), "
            "evb AS (SELECT ev.*, days.b FROM ev JOIN days USING (day))")


def _stream_recursive(alpha: float, points: bool = False) -> str:
    c0, c1 = P.STREAM_STARTS[0][0], P.STREAM_STARTS[1][0]
    w0, w1 = P.STREAM_WEIGHTS
    a = f"pow({float(alpha)!r}, g.m0 + g.m1)" if points else repr(float(alpha))
    near1 = "(e.x0 - s.c1) * (e.x0 - s.c1) < (e.x0 - s.c0) * (e.x0 - s.c0)"

    def upd(j: int) -> str:
        c, w, m, sm = f"s.c{j}", f"s.w{j}", f"g.m{j}", f"g.s{j}"
        nw = f"({a} * {w} + {m})"
        lam = f"({m} / greatest({nw}, 1e-16))"
        cn = (f"CASE WHEN {m} > 0 THEN (1.0 - {lam}) * {c} + ({lam} / {m}) * {sm} "
              f"ELSE {c} END")
        return f"{cn} AS c{j}", f"{nw} AS w{j}"

    u0, u1 = upd(0), upd(1)
    return (
        "WITH RECURSIVE " + _stream_days() + ", "
        f"st(b, c0, c1, w0, w1) AS ("
        f"SELECT 0, CAST({c0} AS DOUBLE), CAST({c1} AS DOUBLE), CAST({w0} AS DOUBLE), CAST({w1} AS DOUBLE) "
        f"UNION ALL "
        f"SELECT s.b + 1, {u0[0]}, {u1[0]}, {u0[1]}, {u1[1]} FROM st s JOIN ("
        f"SELECT s.b, "
        f"CAST(sum(CASE WHEN {near1} THEN 0 ELSE 1 END) AS DOUBLE) AS m0, "
        f"sum(CASE WHEN {near1} THEN 0.0 ELSE e.x0 END) AS s0, "
        f"CAST(sum(CASE WHEN {near1} THEN 1 ELSE 0 END) AS DOUBLE) AS m1, "
        f"sum(CASE WHEN {near1} THEN e.x0 ELSE 0.0 END) AS s1 "
        f"FROM st s JOIN evb e ON e.b = s.b + 1 GROUP BY s.b) g ON g.b = s.b)"
    )


def _stream_final(alpha: float, points: bool = False) -> str:
    return (_stream_recursive(alpha, points) +
            ", last AS (SELECT * FROM st WHERE b = (SELECT max(b) FROM st)) "
            "SELECT CAST(0 AS BIGINT) AS cluster, round(c0, 6) AS center, round(w0, 6) AS weight FROM last "
            "UNION ALL SELECT CAST(1 AS BIGINT), round(c1, 6), round(w1, 6) FROM last")


def oracle_sql() -> dict[str, str]:
    k, n_top = P.LLOYD_K, P.N_TOP
    sweep = rule_k("part")
    q: dict[str, str] = {}

    # ---- scaling ------------------------------------------------------
    stats_cols = []
    for c in P.PART_COLS:
        x = f"CAST({c} AS DOUBLE)"
        stats_cols.append(
            f"SELECT '{c}' AS \"column\", CAST(count(*) AS BIGINT) AS n, round(sum({x}), 2) AS sum, "
            f"round(sum({x} * {x}), 2) AS sum_sq, round(avg({x}), 6) AS mean, "
            f"round(stddev_pop({x}), 6) AS sd_pop, round(stddev_samp({x}), 6) AS sd_samp FROM part")
    q["column_stats"] = " UNION ALL ".join(stats_cols)
    q["zscore"] = ("WITH " + part_points(True) +
                   " SELECT id AS p_partkey, round(x0, 6) AS z_size, round(x1, 6) AS z_price FROM pts")
    q["unit_scale"] = (
        "WITH s AS (SELECT stddev_samp(CAST(p_size AS DOUBLE)) AS s0, "
        "stddev_samp(CAST(p_retailprice AS DOUBLE)) AS s1 FROM part) "
        "SELECT p_partkey, round(CASE WHEN s0 > 0 THEN CAST(p_size AS DOUBLE) / s0 ELSE 0.0 END, 6) AS u_size, "
        "round(CASE WHEN s1 > 0 THEN CAST(p_retailprice AS DOUBLE) / s1 ELSE 0.0 END, 6) AS u_price "
        "FROM part, s")

    # ---- k estimate ---------------------------------------------------
    q["k_estimate"] = ("SELECT CAST(count(*) AS BIGINT) AS n, "
                       "CAST(floor(sqrt(count(*) // 2)) AS BIGINT) AS k FROM lineitem")

    # ---- categories ---------------------------------------------------
    q["category_index"] = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", category, CAST(dense_rank() OVER (ORDER BY category) - 1 AS BIGINT) AS idx "
        f"FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS category FROM part)" for c in P.PART_CATS)
    q["one_hot"] = " UNION ALL ".join(
        f"SELECT p_partkey, '{c}' AS \"column\", CAST(d.idx AS BIGINT) AS slot, 1.0 AS value FROM part JOIN "
        f"(SELECT category, dense_rank() OVER (ORDER BY category) - 1 AS idx FROM "
        f"(SELECT DISTINCT CAST({c} AS VARCHAR) AS category FROM part)) d ON d.category = part.{c}"
        for c in P.PART_CATS)
    width = " + ".join(f"(SELECT count(DISTINCT {c}) FROM part)" for c in P.PART_CATS)
    q["encoded_features"] = (
        f"SELECT p_partkey, CAST({len(P.PART_COLS)} + {width} AS BIGINT) AS width, "
        f"CAST((CASE WHEN p_size <> 0 THEN 1 ELSE 0 END) + (CASE WHEN p_retailprice <> 0 THEN 1 ELSE 0 END) "
        f"+ {len(P.PART_CATS)} AS BIGINT) AS nnz, "
        f"concat_ws(',', CASE WHEN p_size <> 0 THEN '0' END, CASE WHEN p_retailprice <> 0 THEN '1' END, "
        f"CAST(2 + b.i AS VARCHAR), CAST(2 + (SELECT count(DISTINCT p_brand) FROM part) + t.i AS VARCHAR)) AS slots, "
        f"round(sqrt(CAST(p_size AS DOUBLE) * p_size + p_retailprice * p_retailprice + {len(P.PART_CATS)}), 6) AS norm "
        f"FROM part JOIN (SELECT p_brand, dense_rank() OVER (ORDER BY p_brand) - 1 AS i FROM (SELECT DISTINCT p_brand FROM part)) b USING (p_brand) "
        f"JOIN (SELECT p_type, dense_rank() OVER (ORDER BY p_type) - 1 AS i FROM (SELECT DISTINCT p_type FROM part)) t USING (p_type)")

    # ---- fitted report, incomplete rows, null and unseen categories ---
    q["default_report"] = (
        "WITH " + emb_fitted() + f" SELECT CAST(asg.cluster AS BIGINT) AS cluster, label, CAST(count(*) AS BIGINT) AS cnt, "
        f"round(any_value(c.x0), 6) AS c0, round(any_value(c.x{P.EMB_DIM - 1}), 6) AS c63 "
        f"FROM asg JOIN c{P.LLOYD_ITERS} c ON c.cluster = asg.cluster GROUP BY asg.cluster, label")
    q["lloyd_incomplete_rows"] = (
        "WITH pts AS (SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS x0, CAST(p_retailprice AS DOUBLE) AS x1 "
        "FROM part WHERE p_partkey % 10 <> 0 AND p_partkey % 13 <> 0), " + lloyd_ctes(2, f"[{P.LLOYD_K}]", P.LLOYD_ITERS) +
        " SELECT p_partkey, CAST(coalesce(cluster, -1) AS BIGINT) AS cluster, coalesce(round(sqrt(d2), 4), -1.0) AS dist FROM part LEFT JOIN fin ON fin.id = p_partkey")
    q["category_null_unseen"] = (
        "WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_type END AS c FROM part), "
        "d AS (SELECT c, row_number() OVER (ORDER BY c NULLS FIRST) - 1 AS i FROM (SELECT DISTINCT c FROM p WHERE p_partkey % 16 = 0)) "
        "SELECT p_partkey, CAST(coalesce(i, (SELECT count(*) FROM d)) AS BIGINT) AS slot FROM p LEFT JOIN d ON d.c IS NOT DISTINCT FROM p.c")

    # ---- facts of random starts --------------------------------------
    for name in ("scaled", "raw"):
        q[f"restart_facts_{name}"] = (f"SELECT CAST(unnest({rule_k('part')}) AS BIGINT) AS k, (SELECT count(*) FROM part) AS n, "
                                      "true AS monotone, true AS best, true AS complete")
    q["kmeans_fit_facts"] = "SELECT CAST(2 AS BIGINT) AS k, count(*) AS n, true AS both_used, true AS monotone FROM lineitem"
    q["lineitem_anomaly_facts"] = ("SELECT CAST(floor(sqrt(count(*) // 2)) AS BIGINT) AS k, count(*) AS n, true AS all_assigned, "
                                   "true AS fewer_above, true AS n_at_least FROM lineitem")
    q["record_anomaly_facts"] = "SELECT count(*) AS n, count(*) AS lines, true AS fewer_above, true AS n_at_least FROM orders"
    q["pca_norms"] = (f"SELECT p_partkey, round(sqrt(CAST(p_size AS DOUBLE) * p_size + p_retailprice * p_retailprice "
                      f"+ {len(P.PART_CATS)}), 4) AS norm FROM part")
    q["pca_mahalanobis"] = (
        "WITH " + part_points(False) + ", m AS (SELECT avg(x0) AS m0, avg(x1) AS m1, var_pop(x0) AS a, covar_pop(x0, x1) AS b, "
        "var_pop(x1) AS c FROM pts) SELECT id AS p_partkey, round((c * (x0 - m0) * (x0 - m0) - 2 * b * (x0 - m0) * (x1 - m1) "
        "+ a * (x1 - m1) * (x1 - m1)) / (a * c - b * b), 4) AS d2 FROM pts, m")
    varied = " + ".join([f"(SELECT CASE WHEN count(DISTINCT {c}) > 1 THEN 1 ELSE 0 END FROM part)" for c in P.PART_COLS] +
                        [f"(SELECT CASE WHEN count(DISTINCT {c}) > 1 THEN count(DISTINCT {c}) ELSE 0 END FROM part)" for c in P.PART_CATS])
    q["elbow_encoded_k1"] = (f"SELECT CAST(1 AS BIGINT) AS k, count(*) AS n, round(CAST(count(*) * ({varied}) AS DOUBLE), 3) AS cost FROM part")
    q["entropy_encoded_k1"] = (
        "WITH c AS (SELECT o_orderpriority, count(*) AS cnt FROM orders GROUP BY o_orderpriority), t AS (SELECT sum(cnt) AS n FROM c) "
        "SELECT CAST(1 AS BIGINT) AS k, round(-sum((cnt / n) * ln(cnt / n)), 6) AS score FROM c, t")

    # ---- records parsed from lines built out of orders ---------------
    q["split_fields"] = (
        "WITH " + ORDERS_LINE + " SELECT CAST(f[1] AS BIGINT) AS line_key, CAST(len(f) AS BIGINT) AS n_fields, "
        "f[3] AS status, f[5] AS bucket_raw, f[6] AS tail FROM fl")
    q["last_field_histogram"] = (
        "WITH " + ORDERS_LINE + " SELECT last_field, CAST(count(*) AS BIGINT) AS cnt FROM "
        "(SELECT string_split(rtrim(line, ','), ',')[-1] AS last_field FROM lines) GROUP BY last_field")
    q["blank_to_zero"] = ("WITH " + ORDERS_LINE +
                          f" SELECT CAST(f[1] AS BIGINT) AS line_key, {_b2z('f[5]')} AS bucket FROM fl")
    q["numeric_features"] = (
        "WITH " + ORDERS_LINE + f" SELECT {_b2z('f[1]')} AS orderkey, {_b2z('f[2]')} AS custkey, "
        f"{_b2z('f[5]')} AS bucket FROM fl")
    q["label_features"] = (
        "WITH " + ORDERS_LINE + f" SELECT f[4] AS label, {_b2z('f[1]')} AS orderkey, "
        f"{_b2z('f[2]')} AS custkey, {_b2z('f[5]')} AS bucket FROM fl")

    q["trade_records"] = (
        "SELECT concat_ws('-', l_orderkey, l_linenumber) AS label, l_returnflag || l_linestatus AS product_type, l_returnflag AS buy_sell, l_linestatus AS audit_action, "
        "'' AS currency, CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS trade_date, CAST(l_quantity AS DOUBLE) AS quantity, "
        "CAST(l_extendedprice AS DOUBLE) AS notional, CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE CAST(l_tax AS DOUBLE) END AS sec_amount, "
        "CASE WHEN l_returnflag = 'A' THEN 0.0 ELSE CAST(l_linenumber AS DOUBLE) END AS trade_version, CAST(27 AS BIGINT) AS n_columns FROM lineitem")

    # ---- vectors on embeddings ---------------------------------------
    d = P.EMB_DIM
    q["vector_distance"] = (
        "WITH " + emb_points() +
        f", first_row AS (SELECT * FROM pts ORDER BY id LIMIT 1) "
        f"SELECT p.id AS vec_id, round(sqrt({_d2(d, 'p', 'c')}), 6) AS dist FROM pts p, first_row c")
    q["assign_nearest"] = "WITH " + emb_points() + " SELECT id AS vec_id, CAST(cluster AS BIGINT) AS cluster FROM asg0"
    q["dist_to_centroid"] = ("WITH " + emb_fitted() + " SELECT id AS vec_id, CAST(cluster AS BIGINT) AS cluster, "
                             "round(sqrt(d2), 6) AS dist FROM asg")
    q["mean_distance"] = ("WITH " + emb_fitted() +
                          f" SELECT CAST({P.EMB_K} AS BIGINT) AS k, round(avg(sqrt(d2)), 6) AS mean_dist FROM asg")
    q["cluster_label_count"] = ("WITH " + emb_fitted() + " SELECT CAST(cluster AS BIGINT) AS cluster, label, "
                                "CAST(count(*) AS BIGINT) AS cnt FROM asg GROUP BY cluster, label")
    q["label_entropy"] = (
        "WITH c AS (SELECT label, count(*) AS cnt FROM embeddings GROUP BY label), "
        "t AS (SELECT sum(cnt) AS n FROM c) "
        "SELECT round(-sum((cnt / n) * ln(cnt / n)), 6) AS entropy, CAST(max(n) AS BIGINT) AS n FROM c, t")
    q["weighted_entropy"] = (
        "WITH " + emb_fitted() + ", cnt AS (SELECT cluster, label, count(*) AS cnt FROM asg GROUP BY cluster, label), "
        "sz AS (SELECT cluster, sum(cnt) AS size FROM cnt GROUP BY cluster), "
        "ent AS (SELECT cnt.cluster, sz.size, -sum((cnt / size) * ln(cnt / size)) AS entropy "
        "FROM cnt JOIN sz USING (cluster) GROUP BY cnt.cluster, sz.size) "
        "SELECT round(sum(size * entropy) / sum(size), 6) AS score FROM ent")

    # ---- fixed-start Lloyd on part -----------------------------------
    q["lloyd_fixed_init"] = (
        _lloyd_part(False, f"[{k}]") +
        f", sizes AS (SELECT cluster, count(*) AS n FROM fin GROUP BY cluster) "
        f"SELECT CAST(c.cluster AS BIGINT) AS cluster, round(c.x0, 4) AS c_size, round(c.x1, 4) AS c_price, "
        f"CAST(coalesce(s.n, 0) AS BIGINT) AS n FROM c{P.LLOYD_ITERS} c LEFT JOIN sizes s USING (cluster)")
    q["centers_csv"] = (
        _lloyd_part(False, f"[{k}]") +
        f" SELECT CAST(cluster AS BIGINT) AS cluster, concat_ws(',', CAST(CAST(round(x0) AS BIGINT) AS VARCHAR), "
        f"CAST(CAST(round(x1) AS BIGINT) AS VARCHAR)) AS center_csv FROM c{P.LLOYD_ITERS}")
    q["elbow_scores"] = (_lloyd_part(False, sweep) +
                         " SELECT CAST(k AS BIGINT) AS k, round(avg(sqrt(d2)), 6) AS score FROM fin GROUP BY k")
    q["elbow_scores_scaled"] = (_lloyd_part(True, sweep) +
                                " SELECT CAST(k AS BIGINT) AS k, round(avg(sqrt(d2)), 6) AS score FROM fin GROUP BY k")
    q["scatter_points"] = (
        _lloyd_part(True, f"[{k}]") +
        " SELECT 'row' AS kind, id, round(x0, 6) AS x, round(x1, 6) AS y, CAST(cluster AS BIGINT) AS cluster FROM fin "
        f"UNION ALL SELECT 'centre', CAST(cluster AS BIGINT), round(x0, 6), round(x1, 6), CAST(cluster AS BIGINT) "
        f"FROM c{P.LLOYD_ITERS}")

    # ---- anomalies ----------------------------------------------------
    q["topn_threshold"] = _anomaly_base() + " SELECT round(threshold, 6) AS threshold FROM thr"
    q["anomaly_flags"] = (_anomaly_base() +
                          " SELECT id AS p_partkey, CAST(cluster AS BIGINT) AS cluster, round(sqrt(d2), 6) AS dist, "
                          "sqrt(d2) > threshold AS is_anomaly FROM fin, thr")
    q["anomaly_rows"] = (_anomaly_base() +
                         " SELECT id AS p_partkey, CAST(cluster AS BIGINT) AS cluster, round(sqrt(d2), 6) AS dist "
                         "FROM fin, thr WHERE sqrt(d2) > threshold")

    # ---- PCA closed form (2 columns) ---------------------------------
    pca = (
        "WITH " + part_points(False) + ", "
        "cv AS (SELECT var_samp(x0) AS a, covar_samp(x0, x1) AS b, var_samp(x1) AS c FROM pts), "
        "ev AS (SELECT a, b, c, (a + c) / 2 + sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS l1, "
        "(a + c) / 2 - sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS l2 FROM cv), "
        "vec AS (SELECT l1, l2, b / sqrt(b * b + (l1 - a) * (l1 - a)) AS u0, (l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) AS u1, "
        "b / sqrt(b * b + (l2 - a) * (l2 - a)) AS v0, (l2 - a) / sqrt(b * b + (l2 - a) * (l2 - a)) AS v1 FROM ev), "
        "sg AS (SELECT l1, l2, u0, u1, v0, v1, "
        "CASE WHEN abs(u0) >= abs(u1) THEN sign(u0) ELSE sign(u1) END AS su, "
        "CASE WHEN abs(v0) >= abs(v1) THEN sign(v0) ELSE sign(v1) END AS sv FROM vec)")
    q["pca_2d"] = (pca + " SELECT id AS p_partkey, round(x0 * (u0 * su) + x1 * (u1 * su), 4) AS pc1, "
                   "round(x0 * (v0 * sv) + x1 * (v1 * sv), 4) AS pc2 FROM pts, sg")
    q["explained_variance"] = (
        pca + " SELECT CAST(1 AS BIGINT) AS component, round(l1 / (l1 + l2), 6) AS ratio, "
        "round(l1 / (l1 + l2), 6) AS cumulative FROM sg UNION ALL "
        "SELECT CAST(2 AS BIGINT), round(l2 / (l1 + l2), 6), round((l1 + l2) / (l1 + l2), 6) FROM sg")

    least = "(VALUES " + ", ".join(f"(CAST({t} AS DOUBLE))" for t in P.VARIANCE_TARGETS) + ") t(target)"
    q["components_for_variance"] = (
        pca + " SELECT 'raw' AS columns, target, CAST(CASE WHEN l1 / (l1 + l2) >= target THEN 1 ELSE 2 END AS BIGINT) AS m "
        f"FROM sg, {least} UNION ALL SELECT 'scaled', target, CAST(CASE WHEN (1 + abs(r)) / 2 >= target THEN 1 ELSE 2 END AS BIGINT) "
        f"FROM (SELECT corr(CAST(p_size AS DOUBLE), p_retailprice) AS r FROM part), {least}")
    wide = " + ".join([str(len(P.PART_COLS))] + [f"count(DISTINCT {c})" for c in P.PART_CATS])
    q["pca_chosen_components"] = f"SELECT count(*) AS n, CAST({wide} AS BIGINT) AS width, true AS reached, true AS least FROM part"
    q["batch_text_scan"] = "WITH " + ORDERS_LINE + " SELECT line FROM lines"
    q["record_anomalies_many"] = (f"SELECT CAST({P.RECORD_K} AS BIGINT) AS k, count(*) AS n, true AS within_k, true AS fewer_above FROM orders")

    # ---- label encoded: entries (id, slot, value) ----------------------
    z = [f"CASE WHEN stddev_pop({c}) OVER () <= 0 THEN {c} - avg({c}) OVER () ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END AS z{i}"
         for i, c in enumerate(P.PART_COLS)]
    cats = [*P.PART_CATS, f"CAST({P.PART_KEY} AS VARCHAR)"]
    ranks = [f"dense_rank() OVER (ORDER BY {c}) - 1 AS r{i}" for i, c in enumerate(cats)]
    sizes = [f"(SELECT count(DISTINCT {c}) FROM part)" for c in cats]
    first = [" + ".join([str(len(P.PART_COLS)), *sizes[:i]]) for i in range(len(cats))]
    entries = " UNION ALL ".join([f"SELECT id, {i} AS slot, z{i} AS v FROM zr WHERE z{i} <> 0" for i in range(len(P.PART_COLS))]
                                 + [f"SELECT id, {f} + r{i}, 1.0 FROM zr" for i, f in enumerate(first)])
    sparse = f"WITH zr AS (SELECT {P.PART_KEY} AS id, {', '.join(z + ranks)} FROM part), e AS ({entries}) "
    q["sparse_label_rows"] = (
        sparse + f"SELECT id AS {P.PART_KEY}, CAST({' + '.join([str(len(P.PART_COLS)), *sizes])} AS BIGINT) AS width, count(*) AS slots, "
        "CAST(max(slot) AS BIGINT) AS label_slot, round(sum(v * v), 4) AS norm2 FROM e GROUP BY id")
    q["sparse_lloyd_update"] = (
        sparse + f", st AS (SELECT id, row_number() OVER (ORDER BY id) AS j FROM zr QUALIFY j <= {P.LLOYD_K}), "
        "c AS (SELECT j, slot, v FROM e JOIN st USING (id)), cn AS (SELECT j, sum(v * v) AS n FROM c GROUP BY j), "
        "dots AS (SELECT e.id, c.j, sum(e.v * c.v) AS dot FROM e JOIN c USING (slot) GROUP BY e.id, c.j), "
        "near AS (SELECT zr.id, arg_min(cn.j, (cn.n - 2 * coalesce(dot, 0), cn.j)) AS j FROM zr CROSS JOIN cn LEFT JOIN dots ON dots.id = zr.id AND dots.j = cn.j GROUP BY zr.id), "
        "m AS (SELECT j, slot, sum(v) / any_value(n) AS v FROM e JOIN (SELECT id, j, count(*) OVER (PARTITION BY j) AS n FROM near) USING (id) GROUP BY j, slot) "
        "SELECT j - 1 AS cluster, count(*) AS slots, round(sum(v * v), 4) AS norm2 FROM m WHERE v <> 0 GROUP BY j")

    # ---- Kafka value decode (static frame) ----------------------------
    q["kafka_value_decode"] = (
        "SELECT CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS BIGINT) AS user_id, event_type, "
        "concat_ws(',', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), event_type) AS line FROM events")

    # ---- stream replay over event days -------------------------------
    alpha = 0.5 ** (1.0 / P.STREAM_HALF_LIFE)
    q["stream_kmeans_halflife"] = _stream_final(alpha)
    q["stream_kmeans_decay1"] = _stream_final(1.0)
    # the state after the last but one day, from the rows of the state table up to it
    q["stream_latest_model"] = (
        _stream_recursive(alpha) + ", ks AS (SELECT b, CAST(0 AS BIGINT) AS cluster, c0 AS c, w0 AS w FROM st WHERE b > 0 "
        "UNION ALL SELECT b, CAST(1 AS BIGINT), c1, w1 FROM st WHERE b > 0) "
        "SELECT days.day, CAST(ks.b AS BIGINT) AS step, cluster, round(c, 6) AS center, round(w, 6) AS weight FROM ks JOIN days USING (b)")
    q["stream_kmeans_points"] = _stream_final(P.STREAM_POINTS_DECAY, points=True)
    q["stream_file_rows"] = (
        "WITH " + ORDERS_LINE + f" SELECT CAST(f[1] AS BIGINT) AS line_key, CAST(len(f) AS BIGINT) AS n_fields, "
        f"f[3] AS status, {_b2z('f[5]')} AS bucket FROM fl")
    q["stream_batch_counts"] = (
        "WITH " + _stream_days() + " SELECT day, CAST(b AS BIGINT) AS batch, CAST(count(*) AS BIGINT) AS rows "
        "FROM evb GROUP BY day, b")
    q["stream_running_count"] = (
        "WITH " + _stream_days() + ", c AS (SELECT day, b, count(*) AS rows FROM evb GROUP BY day, b) "
        "SELECT day, CAST(rows AS BIGINT) AS rows, CAST(sum(rows) OVER (ORDER BY b) AS BIGINT) AS running FROM c")
    q["stream_k_estimate"] = (
        "WITH " + _stream_days() + ", c AS (SELECT day, b, floor(sqrt(count(*) // 2)) AS bk FROM evb GROUP BY day, b) "
        "SELECT day, CAST(bk AS BIGINT) AS batch_k, "
        "CAST(floor(sum(bk) OVER (ORDER BY b) / b) AS BIGINT) AS mean_k FROM c")
    q["stream_predictions"] = (
        _stream_recursive(alpha) +
        " SELECT e.event_id, e.day, CAST(CASE WHEN (e.x0 - s.c1) * (e.x0 - s.c1) < (e.x0 - s.c0) * (e.x0 - s.c0) "
        "THEN 1 ELSE 0 END AS BIGINT) AS cluster, "
        "round(sqrt(least((e.x0 - s.c0) * (e.x0 - s.c0), (e.x0 - s.c1) * (e.x0 - s.c1))), 6) AS dist "
        "FROM evb e JOIN st s ON s.b = e.b")
    q["stream_anomalies"] = (
        "WITH " + _stream_days() + ", "
        "zs AS (SELECT day, avg(x0) AS m, stddev_pop(x0) AS s FROM evb GROUP BY day), "
        "pts AS (SELECT evb.day AS g, evb.event_id AS id, "
        "CASE WHEN zs.s <= 0 THEN evb.x0 - zs.m ELSE (evb.x0 - zs.m) / zs.s END AS x0 "
        "FROM evb JOIN zs USING (day)), " +
        grouped_lloyd_ctes(1, P.STREAM_ANOMALY_K, P.LLOYD_ITERS) +
        f", thr AS (SELECT g, min(dist) AS threshold FROM (SELECT g, sqrt(d2) AS dist, "
        f"row_number() OVER (PARTITION BY g ORDER BY sqrt(d2) DESC) AS r FROM fin) "
        f"WHERE r <= {P.STREAM_N_TOP} GROUP BY g) "
        "SELECT fin.id AS event_id, fin.g AS day, CAST(fin.cluster AS BIGINT) AS cluster, "
        "round(sqrt(fin.d2), 6) AS dist FROM fin JOIN thr USING (g) WHERE sqrt(fin.d2) > thr.threshold")
    q["stream_unit_scale"] = (
        "WITH " + _stream_days() + ", sd AS (SELECT b, stddev_samp(x0) AS s FROM evb GROUP BY b) "
        "SELECT e.event_id, e.day, round(CASE WHEN sd.s > 0 THEN e.x0 / sd.s ELSE 0.0 END, 6) AS scaled "
        "FROM evb e JOIN sd USING (b)")
    near = "least(" + ", ".join(f"abs(x0 - {c[0]})" for c in P.STREAM_STARTS) + ")"
    q["stream_topn_state"] = (
        "WITH " + _stream_days() + f", p AS (SELECT e.event_type, {near} AS dist, (b - 1) // CAST(ceil(max(b) OVER () / {P.STREAM_PARTS}) AS BIGINT) AS epoch "
        "FROM evb JOIN events e USING (event_id)), "
        "k AS (SELECT DISTINCT epoch, event_type FROM p), "
        "h AS (SELECT k.epoch, k.event_type, dist, row_number() OVER (PARTITION BY k.epoch, k.event_type ORDER BY dist DESC) AS nth, "
        "count(*) OVER (PARTITION BY k.epoch, k.event_type) AS seen FROM k JOIN p ON p.epoch <= k.epoch AND p.event_type = k.event_type), "
        f"t AS (SELECT epoch, event_type, any_value(seen) AS seen, min(dist) AS t FROM h WHERE nth <= {P.STREAM_N_TOP} GROUP BY epoch, event_type) "
        "SELECT CAST(t.epoch AS BIGINT) AS epoch, t.event_type, t.seen, round(t, 6) AS threshold, "
        "(SELECT count(*) FROM h WHERE h.epoch = t.epoch AND h.event_type = t.event_type AND h.dist > t.t) AS above FROM t")
    q["stream_empty_batch"] = (
        "WITH " + _stream_days() + f", p AS (SELECT day, b, 2 * ((b - 1) // CAST(ceil(max(b) OVER () / {P.STREAM_PARTS}) AS BIGINT)) AS epoch FROM evb) "
        "SELECT CAST(epoch AS BIGINT) AS epoch, day, CAST(b AS BIGINT) AS batch, CAST(count(*) AS BIGINT) AS rows FROM p GROUP BY epoch, day, b")
    q["stream_running_scale"] = (
        "WITH " + _stream_days() + ", sd AS (SELECT event_id, day, x0, stddev_samp(x0) OVER (ORDER BY b) AS s FROM evb) "
        "SELECT event_id, day, round(CASE WHEN s > 0 THEN x0 / s ELSE 0.0 END, 6) AS scaled FROM sd")
    q["stream_moments"] = (
        "WITH " + _stream_days() + ", m AS (SELECT day, count(x0) OVER w AS n, avg(x0) OVER w AS mean, stddev_samp(x0) OVER w AS sd "
        "FROM evb WINDOW w AS (ORDER BY b)) "
        "SELECT DISTINCT day, n, round(mean, 6) AS mean, round(sd, 6) AS sd FROM m")
    q["stream_committed_epochs"] = (
        "WITH " + _stream_days() + f", p AS (SELECT day, b, (b - 1) // CAST(ceil(max(b) OVER () / {P.STREAM_PARTS}) AS BIGINT) AS epoch FROM evb), "
        f"found AS ({q['stream_anomalies']}), "
        "a AS (SELECT epoch, count(*) AS anomalies FROM found JOIN (SELECT DISTINCT day, epoch FROM p) USING (day) GROUP BY epoch), "
        "c AS (SELECT epoch, count(*) AS rows, count(DISTINCT day) AS days FROM p GROUP BY epoch) "
        "SELECT CAST(epoch AS BIGINT) AS epoch, rows, CAST(sum(rows) OVER (ORDER BY epoch) AS BIGINT) AS running, rows AS predicted, days, "
        f"CAST(days * {P.STREAM_K} AS BIGINT) AS centres, anomalies FROM c JOIN a USING (epoch)")
    q["stream_prepared_rows"] = (
        "WITH " + ORDERS_LINE + f", pts AS (SELECT CAST(f[1] AS BIGINT) AS id, {_b2z('f[2]')} AS x0, {_b2z('f[5]')} AS x1 FROM fl), "
        "m AS (SELECT avg(x0) AS m0, avg(x1) AS m1, var_pop(x0) AS a, covar_pop(x0, x1) AS b, var_pop(x1) AS c FROM pts) "
        "SELECT id AS line_key, round((c * (x0 - m0) * (x0 - m0) - 2 * b * (x0 - m0) * (x1 - m1) "
        "+ a * (x1 - m1) * (x1 - m1)) / (a * c - b * b), 4) AS d2 FROM pts, m")
    q["stream_kmeans_update"] = (
        f"SELECT CAST({P.STREAM_PARTS} AS BIGINT) AS steps, count(*) AS rows, round(CAST(count(*) + {P.STREAM_K} AS DOUBLE), 6) AS weight, "
        "count(*) AS predicted FROM orders")
    q["stream_record_anomalies"] = (
        "WITH " + ORDERS_LINE + f", raw AS (SELECT o_orderkey % {P.STREAM_PARTS} AS g, CAST(f[1] AS BIGINT) AS id, line, "
        f"{_b2z('f[2]')} AS y0, {_b2z('f[5]')} AS y1 FROM fl), "
        "zs AS (SELECT g, avg(y0) AS m0, stddev_pop(y0) AS s0, avg(y1) AS m1, stddev_pop(y1) AS s1 FROM raw GROUP BY g), "
        "pts AS (SELECT raw.g, id, CASE WHEN s0 <= 0 THEN y0 - m0 ELSE (y0 - m0) / s0 END AS x0, "
        "CASE WHEN s1 <= 0 THEN y1 - m1 ELSE (y1 - m1) / s1 END AS x1 FROM raw JOIN zs USING (g)), " +
        grouped_lloyd_ctes(2, P.STREAM_ANOMALY_K, P.LLOYD_ITERS) +
        f", thr AS (SELECT g, min(dist) AS threshold FROM (SELECT g, sqrt(d2) AS dist, "
        f"row_number() OVER (PARTITION BY g ORDER BY sqrt(d2) DESC) AS r FROM fin) "
        f"WHERE r <= {P.STREAM_N_TOP} GROUP BY g) "
        "SELECT lines.line, CAST(fin.cluster AS BIGINT) AS cluster, round(sqrt(fin.d2), 6) AS dist "
        "FROM fin JOIN thr USING (g) JOIN lines ON lines.o_orderkey = fin.id WHERE sqrt(fin.d2) > thr.threshold")
    q["stream_anomaly_facts"] = (f"SELECT CAST(o_orderkey % {P.STREAM_PARTS} AS BIGINT) AS batch, count(*) AS rows, true AS fewer_than_n, "
                                 f"true AS lines_kept FROM orders GROUP BY 1, o_orderkey % {P.STREAM_PARTS}")
    q["stream_pca_facts"] = ("WITH " + _stream_days() + " SELECT day, CAST(count(*) AS BIGINT) AS rows, true AS finite FROM evb GROUP BY day")
    emb_pts = ("pts AS (SELECT vec_id AS id, CAST(label AS BIGINT) AS label, " +
               ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i}" for i in range(P.EMB_DIM)) +
               " FROM embeddings)")
    q["entropy_sweep"] = (
        "WITH " + emb_pts + ", " + lloyd_ctes(P.EMB_DIM, rule_k("embeddings"), P.LLOYD_ITERS) +
        ", lab AS (SELECT fin.k, fin.cluster, pts.label FROM fin JOIN pts USING (id)), "
        "cnt AS (SELECT k, cluster, label, count(*) AS cnt FROM lab GROUP BY k, cluster, label), "
        "sz AS (SELECT k, cluster, sum(cnt) AS size FROM cnt GROUP BY k, cluster), "
        "ent AS (SELECT cnt.k, cnt.cluster, sz.size, -sum((cnt / size) * ln(cnt / size)) AS entropy "
        "FROM cnt JOIN sz USING (k, cluster) GROUP BY cnt.k, cnt.cluster, sz.size) "
        "SELECT CAST(k AS BIGINT) AS k, round(sum(size * entropy) / sum(size), 6) AS score FROM ent GROUP BY k")
    return q

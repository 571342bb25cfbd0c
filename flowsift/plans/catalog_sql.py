"""Oracle SQL (DuckDB) for the query catalogue; keys and column names match ``catalog``."""

from __future__ import annotations

from flowsift.config import DEFAULT_CONFIG, FEATURES, FLAG_LETTERS, DetectionConfig
from flowsift.plans import oracle as o
from flowsift.plans.catalog import ACK_RULE, FEED_LIVE, FEED_OFFSET, FEED_PAGE, RULE_QUERY_NAMES
from flowsift.sources.rulefiles import load_rules

ORACLE: dict[str, str] = {}
FLAGS = [n for _, n in FLAG_LETTERS]
FINDING_COLS = ("flow_id, src_ip, dst_ip, src_port, dst_port, protocol, last_seen_us, finding_order, "
                "detector, rule_id, name, severity, confidence, description, evidence")


def _flows_sql(select: str, cfg: DetectionConfig = DEFAULT_CONFIG) -> str:
    return o.sql([*o.packets_ctes(), *o.flow_ctes(cfg)], select)


def _det_sql(select: str) -> str:
    return o.sql(o.detection_ctes(load_rules()), select)


def _build() -> None:
    q = ORACLE
    q["packets_keyed"] = o.sql(o.packets_ctes(), """SELECT capture_id, pkt_idx, lo_ip, hi_ip, lo_port, hi_port,
  protocol, is_fwd, term AS is_terminator FROM kp""")
    q["flag_counts"] = o.sql(o.packets_ctes(), f"SELECT pkt_idx, {', '.join(FLAGS)} FROM kp")
    q["packet_filter"] = o.sql(o.packets_ctes(), """SELECT capture_id, pkt_idx, ts_us, src_ip, dst_ip, protocol,
  src_port, dst_port, length, tcp_flags
FROM packets WHERE protocol = 6 AND dst_port <= 1023""")
    q["flow_segments"] = o.sql([*o.packets_ctes(), *o.segment_ctes()],
                               "SELECT pkt_idx, seg_idx, is_start, iat_us IS NOT NULL AS has_iat, coalesce(iat_us, 0) AS iat_us FROM s4")
    never = DetectionConfig(active_timeout_s=1e9)
    q["flows_idle"] = _flows_sql("""SELECT flow_id, first_pkt_idx, first_seen_us, last_seen_us, total_packets,
  total_bytes, close_reason FROM flows""", never)
    q["flows_active_cut"] = _flows_sql("""SELECT capture_id, lo_ip, hi_ip, lo_port, hi_port, protocol, seg_idx,
  cut_idx, cut_ts FROM ch WHERE cut_idx <> seg_idx""")
    q["flow_features"] = _flows_sql("SELECT * FROM flows")
    q["flows_across_captures"] = _flows_sql(f"""SELECT src_ip, dst_ip, src_port, dst_port, protocol, first_seen_us, last_seen_us,
  close_reason, {', '.join(FEATURES)} FROM flows""")
    from flowsift.plans.catalog import _PROJECTIONS

    for name, cols in _PROJECTIONS.items():
        q[name] = _flows_sql(f"SELECT flow_id, {', '.join(cols)} FROM flows")
    q["engine_counters"] = _flows_sql("""SELECT (SELECT count(*) FROM packets) AS packets_seen,
  (SELECT count(*) FROM flows) AS flows_evaluated, CAST(0 AS BIGINT) AS active_flows""")
    for rid, name in RULE_QUERY_NAMES.items():
        q[name] = _det_sql(f"SELECT flow_id, rule_id, severity, confidence FROM rule_findings WHERE rule_id = '{rid}'")
    q["rule_findings"] = _det_sql(f"SELECT {FINDING_COLS} FROM rule_findings")
    q["rule_findings_longform"] = q["rule_findings"]
    q["scan_window_counts"] = _det_sql("SELECT flow_id, distinct_ports, distinct_hosts FROM scan_counts")
    q["scan_findings"] = _det_sql(f"SELECT {FINDING_COLS} FROM scan_findings")
    q["all_findings"] = _det_sql(f"SELECT {FINDING_COLS} FROM findings")
    q["alerts"] = _det_sql("SELECT * FROM alerts")
    q["alert_list"] = _det_sql("SELECT * FROM alerts ORDER BY created_at DESC, id LIMIT 100")
    q["alert_list_filtered"] = _det_sql("""SELECT * FROM alerts WHERE severity = 'medium' AND detector = 'signature'
ORDER BY created_at DESC, id LIMIT 50 OFFSET 10""")
    q["alert_get"] = _det_sql("SELECT * FROM alerts WHERE id = (SELECT min(id) FROM alerts)")
    acks = f"""SELECT id FROM alerts WHERE rule_id = '{ACK_RULE}'
  UNION ALL SELECT md5(flow_id || '|UNKNOWN') FROM flows WHERE protocol = 1"""
    q["alert_ack_view"] = _det_sql(f"""SELECT id, rule_id, id IN (SELECT id FROM ({acks}) a) AS acknowledged
FROM alerts""")
    q["alert_unknown_acks"] = _det_sql(f"""SELECT DISTINCT id FROM ({acks}) a
WHERE id NOT IN (SELECT id FROM alerts)""")
    q["alert_stats_total"] = _det_sql("SELECT count(id) AS total FROM alerts")
    q["alert_stats_by_severity"] = _det_sql("SELECT severity, count(id) AS n FROM alerts GROUP BY severity")
    q["alert_stats_by_detector"] = _det_sql("SELECT detector, count(id) AS n FROM alerts GROUP BY detector")
    q["alert_stats_top_sources"] = _det_sql("""SELECT src_ip, count(id) AS n FROM alerts GROUP BY src_ip
ORDER BY n DESC, src_ip LIMIT 10""")
    q["alert_stats_combined"] = _det_sql("""SELECT 'total' AS dim, '' AS key, count(id) AS n FROM alerts
UNION ALL SELECT 'severity', severity, count(id) FROM alerts GROUP BY severity
UNION ALL SELECT 'detector', detector, count(id) FROM alerts GROUP BY detector
UNION ALL SELECT 'src_ip', src_ip, count(id) FROM alerts GROUP BY src_ip""")
    counted = "string_agg('\"' || {k} || '\":' || n, ',' ORDER BY {k}) FROM (SELECT {k}, count(*) AS n FROM alerts GROUP BY {k})"
    q["alert_stats_nested"] = _det_sql(f"""SELECT '{{"total":' || (SELECT count(*) FROM alerts)
  || ',"by_severity":{{' || (SELECT {counted.format(k='severity')}) || '}},"by_detector":{{' || (SELECT {counted.format(k='detector')})
  || '}},"top_src_ips":[' || (SELECT string_agg('{{"src_ip":"' || src_ip || '","n":' || n || '}}', ',' ORDER BY n DESC, src_ip)
    FROM (SELECT src_ip, count(*) AS n FROM alerts GROUP BY src_ip ORDER BY n DESC, src_ip LIMIT 10)) || ']}}' AS stats""")
    q["alert_page_after"] = _det_sql("SELECT * FROM alerts ORDER BY created_at DESC, id LIMIT 100 OFFSET 200")
    # the rules of EDGE_RULES, written out by hand: one predicate each
    q["rule_ops_edge_cases"] = _flows_sql("""SELECT flow_id, rule_id FROM flows, (SELECT unnest([
  {'r': 'eq', 'm': total_packets = 1}, {'r': 'eq_text', 'm': false}, {'r': 'ne', 'm': dst_port <> 443},
  {'r': 'ne_text', 'm': true}, {'r': 'gt', 'm': total_bytes > 60}, {'r': 'gt_text', 'm': false},
  {'r': 'gte', 'm': total_bytes >= 60}, {'r': 'lt', 'm': duration_s < 0.5}, {'r': 'lte', 'm': syn_count <= 1},
  {'r': 'in', 'm': protocol IN (1, 17)}, {'r': 'in_mixed', 'm': dst_port IN (22, 53)}, {'r': 'in_empty', 'm': false},
  {'r': 'in_scalar', 'm': false}, {'r': 'eq_true', 'm': syn_count = 1}, {'r': 'unknown_field', 'm': false},
  {'r': 'unknown_field_ne', 'm': false}, {'r': 'two', 'm': protocol = 6 AND fin_count > 0}, {'r': 'always', 'm': true}]) AS x) e,
  LATERAL (SELECT x.r AS rule_id WHERE x.m) h""")
    q["rule_ops_longform"] = q["rule_ops_edge_cases"]
    q["severity_share"] = _det_sql("""SELECT s.pos, s.severity, CAST(coalesce(c.n, 0) AS BIGINT) AS n,
  coalesce(c.n, 0) * 100.0 / greatest(1, (SELECT count(*) FROM alerts)) AS share_pct
FROM (VALUES (0, 'critical'), (1, 'high'), (2, 'medium'), (3, 'low')) s(pos, severity)
LEFT JOIN (SELECT severity, count(*) AS n FROM alerts GROUP BY severity) c USING (severity)""")
    q["notify_payloads"] = _det_sql("""SELECT id, to_json({'rule_id': rule_id, 'name': name, 'severity': severity,
  'description': description, 'src_ip': src_ip, 'dst_ip': dst_ip}) AS payload
FROM alerts WHERE severity IN ('high', 'critical')""")
    q["live_payloads"] = _det_sql("""SELECT id, 'detection' AS type, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS at,
  rule_id, name, detector, severity, round(confidence, 4) AS confidence, description, src_ip, dst_ip, dst_port
FROM alerts""")
    q["live_latest"] = _det_sql(f"SELECT id, created_at, rule_id FROM alerts ORDER BY created_at DESC, id LIMIT {FEED_LIVE}")
    ep = ("{ip} || ':' || CASE WHEN {port} = 0 THEN '-' ELSE CAST({port} AS VARCHAR) END")
    src, dst = ep.format(ip="src_ip", port="src_port"), ep.format(ip="dst_ip", port="dst_port")
    q["feed_merge"] = _det_sql(f"""SELECT id, origin FROM (
  SELECT id, 0 AS origin, created_at, name, {src} AS src, {dst} AS dst
  FROM (SELECT * FROM alerts ORDER BY created_at DESC, id LIMIT {FEED_LIVE}) l
  UNION ALL
  SELECT id, 1, created_at, name, {src}, {dst}
  FROM (SELECT * FROM alerts ORDER BY created_at DESC, id LIMIT {FEED_PAGE} OFFSET {FEED_OFFSET}) p
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM alerts ORDER BY created_at DESC, id LIMIT {FEED_LIVE}) l2
    WHERE l2.created_at = p.created_at AND l2.name = p.name
      AND {ep.format(ip='l2.src_ip', port='l2.src_port')} = {ep.format(ip='p.src_ip', port='p.src_port')}
      AND {ep.format(ip='l2.dst_ip', port='l2.dst_port')} = {ep.format(ip='p.dst_ip', port='p.dst_port')})
) t""")
    q["console_lines"] = _det_sql("""SELECT id, printf('ALERT [%s] %s (%s, conf=%.2f) %s:%d -> %s:%d \u2014 %s', upper(severity), name,
  detector, confidence, src_ip, src_port, dst_ip, dst_port, description) AS line FROM alerts""")
    q["alert_rows_formatted"] = _det_sql(f"""SELECT id, created_at, severity, name, {src} AS source, {dst} AS target,
  printf('%.0f%%', confidence * 100) AS confidence_pct FROM alerts""")

    q["alert_counts_by_rule"] = _det_sql("SELECT rule_id, severity, count(id) AS n_alerts FROM alerts GROUP BY 1, 2")


_build()


def _report_ctes(rows: str) -> list[tuple[str, str]]:
    """``report``: M10 of ``rows(score, label)`` at 0.5."""
    cnt = f"""SELECT count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp,
  count(*) FILTER (WHERE score >= 0.5 AND label <> 1) AS fp,
  count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn,
  count(*) FILTER (WHERE score < 0.5 AND label <> 1) AS tn FROM {rows}"""

    def div(a, b):
        return f"CASE WHEN ({b}) > 0 THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) ELSE 0.0 END"

    pr = f"""SELECT {div('tp', 'tp + fp')} AS p1, {div('tp', 'tp + fn')} AS r1, tp + fn AS s1,
  {div('tn', 'tn + fn')} AS p0, {div('tn', 'tn + fp')} AS r0, tn + fp AS s0,
  {div('tp + tn', 'tp + tn + fp + fn')} AS acc FROM cnt"""
    f1 = """SELECT *, CASE WHEN p1 + r1 > 0 THEN 2.0 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1,
  CASE WHEN p0 + r0 > 0 THEN 2.0 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0 FROM pr"""

    def w(a, b):
        return div(f"{a} * s0 + {b} * s1", "s0 + s1")

    rep = f"""SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, CAST(s0 AS BIGINT) AS support FROM f1t
UNION ALL SELECT '1', p1, r1, f1, CAST(s1 AS BIGINT) FROM f1t
UNION ALL SELECT 'accuracy', acc, acc, acc, CAST(s0 + s1 AS BIGINT) FROM f1t
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, CAST(s0 + s1 AS BIGINT) FROM f1t
UNION ALL SELECT 'weighted avg', {w('p0', 'p1')}, {w('r0', 'r1')}, {w('f0', 'f1')}, CAST(s0 + s1 AS BIGINT) FROM f1t"""
    return [("cnt", cnt), ("pr", pr), ("f1t", f1), ("report", rep)]


def _rank_ctes(rows: str) -> list[tuple[str, str]]:
    """``ranked``: distinct scores of ``rows(score, label)`` with what lies below and at or above each."""
    return [("grouped", f"""SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
FROM {rows} GROUP BY score"""), ("ranked", """SELECT *, sum(neg) OVER up - neg AS neg_below,
  sum(pos) OVER down AS tp_ge, sum(pos + neg) OVER down AS pred_ge FROM grouped
WINDOW up AS (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  down AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")]


def _training_sql() -> None:
    q = ORACLE
    feats = {
        "duration_s": "CAST(l_linenumber - 1 AS VARCHAR)",
        "fwd_packets": "CAST(l_quantity AS VARCHAR)",
        "bwd_packets": "CAST(floor(l_quantity / 2) AS VARCHAR)",
        "fwd_bytes": "CAST(floor(l_extendedprice) AS VARCHAR)",
        "bwd_bytes": "CAST(floor(l_extendedprice * l_discount) AS VARCHAR)",
        "fwd_pkt_len_mean": "CAST(l_extendedprice / l_quantity AS VARCHAR)",
        "fwd_pkt_len_std": "CAST(l_tax * 1000 AS VARCHAR)",
        "fwd_pkt_len_min": "CAST(l_discount * 100 AS VARCHAR)",
        "fwd_pkt_len_max": "CAST(l_quantity * 10 AS VARCHAR)",
        "bwd_pkt_len_mean": "CAST((l_extendedprice * l_discount) / greatest(1.0, floor(l_quantity / 2)) AS VARCHAR)",
        "bwd_pkt_len_std": "CAST(l_tax * 100 AS VARCHAR)",
        "bwd_pkt_len_min": "'0.0'",
        "bwd_pkt_len_max": "CAST(l_quantity AS VARCHAR)",
        "iat_mean": "CAST(CAST(l_linenumber - 1 AS DOUBLE) / l_quantity AS VARCHAR)",
        "iat_std": "CAST(l_discount * 10 AS VARCHAR)",
        "bytes_per_s": ("CASE WHEN l_linenumber = 1 THEN 'Infinity' ELSE CAST((floor(l_extendedprice) + "
                        "floor(l_extendedprice * l_discount)) / CAST(l_linenumber - 1 AS DOUBLE) AS VARCHAR) END"),
        "packets_per_s": ("CASE WHEN l_linenumber = 1 THEN 'Infinity' ELSE CAST((l_quantity + floor(l_quantity / 2))"
                          " / CAST(l_linenumber - 1 AS DOUBLE) AS VARCHAR) END"),
        "down_up_ratio": "CAST(floor(l_quantity / 2) / l_quantity AS VARCHAR)",
        "syn_count": "CAST(l_linenumber % 2 AS VARCHAR)",
        "ack_count": "CAST(l_partkey % 3 AS VARCHAR)",
        "fin_count": "CAST(CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE 0 END AS VARCHAR)",
        "rst_count": "'0'",
        "psh_count": "CAST(l_suppkey % 2 AS VARCHAR)",
        "urg_count": "'0'",
    }
    parsed = ",\n  ".join(f"TRY_CAST({v} AS DOUBLE) AS {k}" for k, v in feats.items())
    mapped = f"""SELECT {parsed},
  CASE WHEN l_returnflag = 'N' THEN 'BENIGN' WHEN l_returnflag = 'R' THEN 'PortScan' ELSE 'DDoS' END AS label_detail
FROM lineitem"""
    tm = """SELECT *, CASE WHEN upper(coalesce(label_detail, 'nan')) = 'BENIGN' THEN 0 ELSE 1 END AS label,
  fwd_packets + bwd_packets AS total_packets, fwd_bytes + bwd_bytes AS total_bytes FROM mapped"""
    ctes = [("mapped", mapped), ("tm", tm)]
    cols = ", ".join(FEATURES)
    q["training_map"] = o.sql(ctes, f"SELECT {cols}, label, label_detail FROM tm")
    q["label_binarise"] = o.sql(ctes, "SELECT label_detail, label, count(*) AS n FROM tm GROUP BY 1, 2")
    finite = " AND ".join(f"isfinite({f})" for f in FEATURES)
    q["training_clean"] = o.sql(ctes, f"SELECT {cols}, label, label_detail FROM tm WHERE {finite}")

    det = o.detection_ctes(load_rules())
    lab = """SELECT f.*, CASE WHEN f.flow_id IN (SELECT flow_id FROM findings) THEN 1 ELSE 0 END AS label
FROM flows f"""
    split = """SELECT l.*, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(flow_id || '|42'), flow_id)
  <= floor(count(*) OVER (PARTITION BY label) * 0.25 + 0.5) THEN 'test' ELSE 'train' END AS split FROM lab l"""
    sctes = [*det, ("lab", lab), ("spl", split)]
    q["split_stratified"] = o.sql(sctes, "SELECT flow_id, label, split FROM spl")
    parts = [f"""SELECT {i} AS pos, '{f}' AS feature, printf('%.9e', avg({f})) AS mean,
  printf('%.9e', stddev_pop({f})) AS std,
  printf('%.9e', CASE WHEN stddev_pop({f}) = 0 THEN 1.0 ELSE stddev_pop({f}) END) AS scale
FROM spl WHERE split = 'train' AND label = 0""" for i, f in enumerate(FEATURES)]
    q["scaler_params"] = o.sql(sctes, "\nUNION ALL\n".join(parts))
    q["training_metadata"] = o.sql(sctes, """SELECT count(*) AS rows, avg(CAST(label AS DOUBLE)) AS attack_rate,
  count(*) FILTER (WHERE split = 'train' AND label = 0) AS n_train_benign,
  count(*) FILTER (WHERE split = 'test') AS n_test,
  count(*) FILTER (WHERE split = 'test' AND label = 1) AS n_test_attack FROM spl""")

    docs = """SELECT l.doc_id, l.quality AS label, d.n_chars FROM labels l JOIN documents d USING (doc_id)"""
    unit = """SELECT d.*, CASE WHEN mm.hi - mm.lo < 1e-12 THEN 0.0
  ELSE (CAST(n_chars AS DOUBLE) - mm.lo) / (mm.hi - mm.lo) END AS score
FROM docs d, (SELECT min(CAST(n_chars AS DOUBLE)) AS lo, max(CAST(n_chars AS DOUBLE)) AS hi FROM docs) mm"""
    bounds = """SELECT count(*) AS n, min(CAST(n_chars AS DOUBLE)) AS lo,
  quantile_cont(CAST(n_chars AS DOUBLE), 0.995) AS hi FROM docs WHERE label = 1"""
    calib = """SELECT d.doc_id, greatest(0.0, least(1.0, (CAST(d.n_chars AS DOUBLE) - b.lo) / (b.hi - b.lo))) AS score
FROM docs d, bounds b"""
    band = """SELECT *, CASE WHEN score < 0.5 THEN 'none' WHEN score >= 0.9 THEN 'critical'
  WHEN score >= 0.7 THEN 'high' ELSE 'medium' END AS severity FROM calib"""
    g = """SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
FROM unit GROUP BY score"""
    mctes = [("docs", docs), ("unit", unit), ("bounds", bounds), ("calib", calib), ("band", band), ("g", g)]
    q["score_minmax"] = o.sql(mctes, "SELECT doc_id, label, score FROM unit")
    q["calibration_bounds"] = o.sql(mctes, "SELECT n, lo, hi FROM bounds")
    q["calibrated_scores"] = o.sql(mctes, "SELECT doc_id, score, severity FROM band")
    q["severity_bands"] = o.sql(mctes, "SELECT severity, count(*) AS n FROM band GROUP BY severity")
    q["roc_auc"] = o.sql(mctes + [("c", """SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
  AND CURRENT ROW) - neg AS neg_below FROM g""")], """SELECT CASE WHEN sum(pos) * sum(neg) > 0
  THEN CAST(sum(pos * neg_below * 2 + pos * neg) AS DOUBLE) / CAST(sum(pos) * sum(neg) * 2 AS DOUBLE) END AS roc_auc
FROM c""")
    q["average_precision"] = o.sql(mctes + [("c", """SELECT *,
  sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp_ge,
  sum(pos + neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pred_ge FROM g""")],
        """SELECT printf('%.9e', sum((CAST(pos AS DOUBLE) / (SELECT CAST(sum(pos) AS DOUBLE) FROM g))
  * (CAST(tp_ge AS DOUBLE) / CAST(pred_ge AS DOUBLE)))) AS average_precision FROM c""")
    q["classification_report"] = o.sql(mctes + _report_ctes("unit"), "SELECT * FROM report")


_training_sql()


def _stream_sql() -> None:
    from flowsift.plans.catalog import STREAM_FLOW_COLUMNS

    ORACLE["stream_flows"] = _flows_sql(f"SELECT {', '.join(STREAM_FLOW_COLUMNS)} FROM flows")
    ORACLE["stream_flows_late"] = ORACLE["stream_flows"]
    ORACLE["stream_scans"] = ORACLE["scan_findings"]
    ORACLE["stream_alerts"] = ORACLE["alerts"]


_stream_sql()


def _forest_sql() -> None:
    from flowsift.config import ANOMALY_ID, ANOMALY_NAME
    from flowsift.plans.oracle_forest import calibrated_ctes, forest_ctes, score_ctes

    x = "[" + ", ".join(f"coalesce({f}::DOUBLE, 0.0)" for f in FEATURES) + "]"
    labelled = [*o.detection_ctes(load_rules()),
                ("lab", """SELECT f.*, CASE WHEN f.flow_id IN (SELECT flow_id FROM findings) THEN 1 ELSE 0 END AS label FROM flows f"""),
                ("spl", """SELECT l.*, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(flow_id || '|42'), flow_id)
  <= floor(count(*) OVER (PARTITION BY label) * 0.25 + 0.5) THEN 'test' ELSE 'train' END AS split FROM lab l"""),
                ("train_rows", f"SELECT flow_id AS id, {x} AS x FROM spl WHERE split = 'train' AND label = 0"),
                ("all_rows", f"SELECT flow_id AS id, {x} AS x FROM spl"),
                *forest_ctes("train_rows", len(FEATURES)), *score_ctes("all_rows", "scored"),
                ("train_scored", "SELECT * FROM scored WHERE id IN (SELECT id FROM train_rows)"),
                *calibrated_ctes("scored", "train_scored", "calibrated")]
    ORACLE["iforest_scores"] = o.sql(labelled, """SELECT flow_id, label, printf('%.9e', raw) AS raw_score,
  printf('%.9e', score) AS score FROM calibrated JOIN spl ON id = flow_id""")
    ORACLE["anomaly_findings"] = o.sql(labelled, f"""SELECT {o.IDENT}, 2000 AS finding_order, 'anomaly' AS detector,
  '{ANOMALY_ID}' AS rule_id, '{ANOMALY_NAME}' AS name,
  CASE WHEN score >= 0.9 THEN 'critical' WHEN score >= 0.7 THEN 'high' ELSE 'medium' END AS severity,
  round(score, 9) AS confidence,
  printf('Isolation-forest anomaly score %.3f for flow %s:%d -> %s:%d', score, src_ip, src_port, dst_ip, dst_port) AS description,
  to_json({{'anomaly_score': round(score, 4), 'src_ip': src_ip, 'dst_ip': dst_ip, 'dst_port': dst_port}}) AS evidence
FROM calibrated JOIN spl ON id = flow_id WHERE score >= 0.5""")
    run = [*labelled, ("held", "SELECT score, label FROM calibrated JOIN spl ON id = flow_id WHERE split = 'test'"),
           *_rank_ctes("held"), *_report_ctes("held")]
    names = {"rows": "SELECT count(*) FROM spl", "attack_rate": "SELECT avg(label::DOUBLE) FROM spl",
             "n_train_benign": "SELECT count(*) FROM train_rows", "n_test": "SELECT count(*) FROM held",
             "n_test_attack": "SELECT count(*) FROM held WHERE label = 1", "calib_lo": "SELECT lo FROM forest_bounds",
             "calib_hi": "SELECT hi FROM forest_bounds",
             "roc_auc": """SELECT CASE WHEN sum(pos) * sum(neg) > 0 THEN CAST(sum(pos * neg_below * 2 + pos * neg) AS DOUBLE)
  / CAST(sum(pos) * sum(neg) * 2 AS DOUBLE) END FROM ranked""",
             "average_precision": """SELECT sum((CAST(pos AS DOUBLE) / (SELECT CAST(sum(pos) AS DOUBLE) FROM grouped))
  * (CAST(tp_ge AS DOUBLE) / CAST(pred_ge AS DOUBLE))) FROM ranked"""}
    parts = [f"SELECT '{n}' AS name, printf('%.9e', ({x})::DOUBLE) AS value" for n, x in names.items()]
    parts += [f"SELECT class || ' {m}', printf('%.9e', {m}::DOUBLE) FROM report" for m in ("precision", "recall", "f1_score", "support")]
    ORACLE["train_report"] = o.sql(run, "\nUNION ALL ".join(parts))
    emb = [("e", "SELECT vec_id, label, vec_id::VARCHAR AS id, embedding::DOUBLE[] AS x FROM embeddings"),
           ("normal", "SELECT id, x FROM e WHERE label = 0"),
           *forest_ctes("normal", 64), *score_ctes("e", "scored")]
    ORACLE["iforest_embeddings"] = o.sql(emb, """SELECT vec_id, label, printf('%.9e', raw) AS raw_score
FROM scored JOIN e USING (id)""")


_forest_sql()

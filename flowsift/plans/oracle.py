"""DuckDB SQL twins of the Spark plans (the correctness oracle).

Each builder returns named CTEs; ``sql(ctes, select)`` joins them into one statement
that runs on the pre-registered views (``events``, ``lineitem``, ``labels`` ...). The
SQL is written independently of the DataFrame code: plain window functions, a
recursive CTE for the greedy active-timeout cut, and ``count(DISTINCT) OVER RANGE``
for the scan windows.
"""

from __future__ import annotations

from flowsift.config import (
    DEFAULT_CONFIG, FEATURES, FLAG_LETTERS, HOST_SWEEP_ID, HOST_SWEEP_NAME, PORT_SCAN_ID,
    PORT_SCAN_NAME, DetectionConfig,
)
from flowsift.sources.rulefiles import Rule, numeric_members, value_kind

KEY = "capture_id, lo_ip, hi_ip, lo_port, hi_port, protocol"
IDENT = "flow_id, src_ip, dst_ip, src_port, dst_port, protocol, last_seen_us"
RULE_FIELDS = (*FEATURES, "protocol", "dst_port", "src_port")


def sql(ctes: list[tuple[str, str]], select: str) -> str:
    body = ",\n".join(f"{name} AS (\n{text}\n)" for name, text in ctes)
    return f"WITH RECURSIVE {body}\n{select}"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ---------------------------------------------------------------------------
# packets (events projection) and keyed packets
# ---------------------------------------------------------------------------

def packets_ctes() -> list[tuple[str, str]]:
    ev = """SELECT event_id, user_id AS u, event_type AS e, value,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00') AS d
FROM events"""
    pa = """SELECT event_id,
  CASE WHEN e = 'click' THEN d // 100000 WHEN e = 'purchase' THEN d // 36000 ELSE d // 3600 END AS ts_us,
  CASE WHEN e = 'click' THEN '10.0.1.1'
       WHEN e = 'purchase' THEN '10.0.2.' || CAST(u % 2 AS VARCHAR)
       WHEN e = 'signup' THEN '10.0.3.' || CAST(u // 50 AS VARCHAR)
       WHEN e = 'view' THEN '10.0.4.' || CAST(u % 5 AS VARCHAR)
       WHEN u % 2 = 0 THEN '203.0.113.' || CAST(u // 50 AS VARCHAR)
       ELSE '198.51.100.' || CAST(u // 50 AS VARCHAR) END AS ip_a,
  CASE WHEN e = 'error' AND u % 2 = 1 THEN '9.9.10.' || CAST(k % 18 AS VARCHAR) ELSE '9.9.9.1' END AS ip_b,
  CAST(CASE WHEN e = 'click' THEN NULL WHEN e IN ('purchase', 'signup') THEN 50000
       WHEN e = 'view' THEN CASE WHEN k < 10 THEN 51000 + 10 * u + k ELSE 50000 END
       ELSE 40000 + k END AS INTEGER) AS port_a,
  CAST(CASE WHEN e = 'click' THEN NULL WHEN e IN ('purchase', 'signup') THEN 443 WHEN e = 'view' THEN 53
       WHEN u % 2 = 0 THEN k ELSE 22 END AS INTEGER) AS port_b,
  (e IN ('signup', 'view') AND k % 2 = 1) AS rev,
  CAST(CASE WHEN e = 'purchase' THEN 60000 ELSE 54 END + floor(value) AS BIGINT) AS length,
  CASE WHEN e IN ('click', 'view') THEN NULL
       WHEN e = 'purchase' THEN CASE WHEN k = 0 THEN 'FA' ELSE 'S' END
       WHEN e = 'signup' THEN CASE WHEN k = 0 THEN 'FA' WHEN k < 50 THEN 'PA' ELSE 'A' END
       WHEN k % 4 = 0 THEN '' WHEN k % 4 = 1 THEN 'S' WHEN k % 4 = 2 THEN 'F' ELSE 'FPU' END AS tcp_flags,
  CAST(CASE WHEN e = 'click' THEN 1 WHEN e = 'view' THEN 17 ELSE 6 END AS INTEGER) AS protocol
FROM ev"""
    pk = """SELECT 'events' AS capture_id, CAST(event_id AS BIGINT) AS pkt_idx, CAST(ts_us AS BIGINT) AS ts_us,
  CASE WHEN rev THEN ip_b ELSE ip_a END AS src_ip, CASE WHEN rev THEN ip_a ELSE ip_b END AS dst_ip,
  protocol, CASE WHEN rev THEN port_b ELSE port_a END AS src_port,
  CASE WHEN rev THEN port_a ELSE port_b END AS dst_port, length, tcp_flags
FROM pa"""
    flag_cols = ",\n  ".join(
        f"CAST(length(coalesce(tcp_flags, '')) - length(replace(coalesce(tcp_flags, ''), '{l}', '')) AS BIGINT) AS {n}"
        for l, n in FLAG_LETTERS)
    kp = f"""SELECT *,
  CASE WHEN is_fwd THEN src_ip ELSE dst_ip END AS lo_ip,
  CASE WHEN is_fwd THEN dst_ip ELSE src_ip END AS hi_ip,
  CAST(CASE WHEN is_fwd THEN coalesce(src_port, 0) ELSE coalesce(dst_port, 0) END AS INTEGER) AS lo_port,
  CAST(CASE WHEN is_fwd THEN coalesce(dst_port, 0) ELSE coalesce(src_port, 0) END AS INTEGER) AS hi_port
FROM (SELECT *,
  (src_ip < dst_ip OR (src_ip = dst_ip AND coalesce(src_port, 0) <= coalesce(dst_port, 0))) AS is_fwd,
  (instr(coalesce(tcp_flags, ''), 'F') > 0 OR instr(coalesce(tcp_flags, ''), 'R') > 0) AS term,
  {flag_cols}
  FROM packets) t"""
    return [("ev", ev), ("pa", pa), ("packets", pk), ("kp", kp)]


# ---------------------------------------------------------------------------
# flows
# ---------------------------------------------------------------------------

def segment_ctes(cfg: DetectionConfig = DEFAULT_CONFIG) -> list[tuple[str, str]]:
    s1 = f"""SELECT *, lag(ts_us) OVER w AS prev_ts, lag(term) OVER w AS prev_term
FROM kp WINDOW w AS (PARTITION BY {KEY} ORDER BY pkt_idx)"""
    s2 = f"""SELECT *, (prev_ts IS NULL OR prev_term OR ts_us - prev_ts >= {cfg.idle_us}) AS is_start FROM s1"""
    s3 = f"""SELECT *, max(CASE WHEN is_start THEN pkt_idx END) OVER (PARTITION BY {KEY} ORDER BY pkt_idx
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg_idx FROM s2"""
    s4 = f"""SELECT *, first_value(ts_us) OVER (PARTITION BY {KEY}, seg_idx ORDER BY pkt_idx) AS seg_ts,
  CAST(CASE WHEN NOT is_start AND prev_ts <> 0 THEN greatest(0, ts_us - prev_ts) END AS BIGINT) AS iat_us
FROM s3"""
    return [("s1", s1), ("s2", s2), ("s3", s3), ("s4", s4)]


def flow_ctes(cfg: DetectionConfig = DEFAULT_CONFIG) -> list[tuple[str, str]]:
    a = cfg.active_us
    keys = ["capture_id", "lo_ip", "hi_ip", "lo_port", "hi_port", "protocol"]
    on = " AND ".join(f"p.{k} = ch.{k}" for k in keys)
    longseg = f"""SELECT {KEY}, seg_idx, min(seg_ts) AS seg_ts FROM s4
GROUP BY {KEY}, seg_idx HAVING max(ts_us - seg_ts) >= {a}"""
    ch = f"""SELECT {KEY}, seg_idx, seg_idx AS cut_idx, seg_ts AS cut_ts FROM longseg
UNION ALL
SELECT {", ".join("ch." + k for k in keys)}, ch.seg_idx, nx.pkt_idx, nx.ts_us
FROM ch, LATERAL (SELECT p.pkt_idx, p.ts_us FROM s4 p
  WHERE {on} AND p.seg_idx = ch.seg_idx AND p.pkt_idx > ch.cut_idx AND p.ts_us >= ch.cut_ts + {a}
  ORDER BY p.pkt_idx LIMIT 1) nx"""
    join_on = " AND ".join(f"p.{k} = c.{k}" for k in keys)
    fp = f"""SELECT p.*, c.cut_idx IS NOT NULL AS is_cut FROM s4 p
LEFT JOIN ch c ON {join_on} AND c.seg_idx = p.seg_idx AND c.cut_idx = p.pkt_idx"""
    fp2 = f"""SELECT *, coalesce(max(CASE WHEN is_cut THEN pkt_idx END) OVER (PARTITION BY {KEY}, seg_idx
  ORDER BY pkt_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), seg_idx) AS start_idx,
  CASE WHEN is_cut THEN NULL ELSE iat_us END AS iat2,
  max(CASE WHEN is_cut THEN pkt_idx END) OVER (PARTITION BY {KEY}, seg_idx) AS last_cut
FROM fp"""

    def mom(prefix, value, cond):
        filt = f" FILTER (WHERE {cond})" if cond else ""
        return (f"count({value}){filt} AS {prefix}_n, "
                f"sum(CAST({value} AS HUGEINT)){filt} AS {prefix}_s1, "
                f"sum(CAST({value} AS HUGEINT) * CAST({value} AS HUGEINT)){filt} AS {prefix}_s2, "
                f"min({value}){filt} AS {prefix}_min, max({value}){filt} AS {prefix}_max")

    flag_sums = ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for _, n in FLAG_LETTERS)
    fa = f"""SELECT {KEY}, start_idx,
  arg_min(src_ip, pkt_idx) AS o_src_ip, arg_min(dst_ip, pkt_idx) AS o_dst_ip,
  arg_min(coalesce(src_port, 0), pkt_idx) AS o_src_port, arg_min(coalesce(dst_port, 0), pkt_idx) AS o_dst_port,
  arg_min(ts_us, pkt_idx) AS first_seen_us, arg_max(ts_us, pkt_idx) AS last_seen_us,
  arg_max(term, pkt_idx) AS last_term, max(last_cut) AS last_cut,
  {mom('fl', 'length', 'is_fwd')}, {mom('bl', 'length', 'NOT is_fwd')}, {mom('iat', 'iat2', None)},
  {flag_sums}
FROM fp2 GROUP BY {KEY}, start_idx"""

    def mean(p, scale=None):
        m = f"CAST({p}_s1 AS DOUBLE) / {p}_n"
        if scale:
            m = f"({m}) / {scale}"
        return f"CASE WHEN {p}_n > 0 THEN {m} ELSE 0.0 END"

    def std(p, scale=None):
        s = f"sqrt(CAST(CAST({p}_n AS HUGEINT) * {p}_s2 - {p}_s1 * {p}_s1 AS DOUBLE)) / {p}_n"
        if scale:
            s = f"({s}) / {scale}"
        return f"CASE WHEN {p}_n >= 2 THEN {s} ELSE 0.0 END"

    dur = "greatest(1e-6, CAST(last_seen_us - first_seen_us AS DOUBLE) / 1000000.0)"
    feats = {
        "duration_s": dur,
        "total_packets": "CAST(fl_n + bl_n AS BIGINT)",
        "total_bytes": "CAST(coalesce(fl_s1, 0) + coalesce(bl_s1, 0) AS BIGINT)",
        "fwd_packets": "CAST(fl_n AS BIGINT)",
        "bwd_packets": "CAST(bl_n AS BIGINT)",
        "fwd_bytes": "CAST(coalesce(fl_s1, 0) AS BIGINT)",
        "bwd_bytes": "CAST(coalesce(bl_s1, 0) AS BIGINT)",
        "fwd_pkt_len_mean": mean("fl"), "fwd_pkt_len_std": std("fl"),
        "fwd_pkt_len_min": "coalesce(CAST(fl_min AS DOUBLE), 0.0)",
        "fwd_pkt_len_max": "coalesce(CAST(fl_max AS DOUBLE), 0.0)",
        "bwd_pkt_len_mean": mean("bl"), "bwd_pkt_len_std": std("bl"),
        "bwd_pkt_len_min": "coalesce(CAST(bl_min AS DOUBLE), 0.0)",
        "bwd_pkt_len_max": "coalesce(CAST(bl_max AS DOUBLE), 0.0)",
        "iat_mean": mean("iat", "1000000.0"), "iat_std": std("iat", "1000000.0"),
        "bytes_per_s": f"CAST(coalesce(fl_s1, 0) + coalesce(bl_s1, 0) AS DOUBLE) / {dur}",
        "packets_per_s": f"CAST(fl_n + bl_n AS DOUBLE) / {dur}",
        "down_up_ratio": "CASE WHEN fl_n > 0 THEN CAST(bl_n AS DOUBLE) / CAST(fl_n AS DOUBLE) ELSE 0.0 END",
        **{n: n for _, n in FLAG_LETTERS},
    }
    feat_sql = ",\n  ".join(f"{feats[f]} AS {f}" for f in FEATURES)
    flows = f"""SELECT md5(concat_ws('|', {KEY}, start_idx)) AS flow_id, {KEY},
  o_src_ip AS src_ip, o_dst_ip AS dst_ip, CAST(o_src_port AS INTEGER) AS src_port,
  CAST(o_dst_port AS INTEGER) AS dst_port, start_idx AS first_pkt_idx, first_seen_us, last_seen_us,
  CASE WHEN last_term THEN 'fin_rst' WHEN start_idx < coalesce(last_cut, -1) THEN 'active_timeout'
       ELSE 'expired' END AS close_reason,
  {feat_sql}
FROM fa"""
    return [*segment_ctes(cfg), ("longseg", longseg), ("ch", ch), ("fp", fp), ("fp2", fp2),
            ("fa", fa), ("flows", flows)]


# ---------------------------------------------------------------------------
# rules, scans, findings
# ---------------------------------------------------------------------------

def condition_sql(field: str, op: str, value) -> str:
    if field not in RULE_FIELDS:
        return "FALSE"
    kind = value_kind(value)
    x = f"CAST({field} AS DOUBLE)"
    if op == "in":
        if kind != "list":
            return "FALSE"
        mem = numeric_members(value)
        return f"{x} IN ({', '.join(repr(float(m)) for m in mem)})" if mem else "FALSE"
    if kind != "num":
        return "TRUE" if op == "ne" else "FALSE"
    sym = {"eq": "=", "ne": "<>", "gt": ">", "gte": ">=", "lt": "<", "lte": "<="}[op]
    return f"{x} {sym} {float(value)!r}"


def rule_sql(rule: Rule) -> str:
    return " AND ".join(condition_sql(c.field, c.op, c.value) for c in rule.conditions) or "TRUE"


def rule_findings_ctes(rules: list[Rule]) -> list[tuple[str, str]]:
    ev = ("to_json({'src_ip': src_ip, 'dst_ip': dst_ip, 'dst_port': dst_port, "
          "'duration_s': CAST((greatest(last_seen_us - first_seen_us, 0) + 500) // 1000 AS DOUBLE) / 1000.0, "
          "'total_packets': total_packets})")
    parts = [
        f"""SELECT {IDENT}, {i} AS finding_order, 'signature' AS detector, {_q(r.id)} AS rule_id,
  {_q(r.name)} AS name, {_q(r.severity)} AS severity, CAST({float(r.confidence)!r} AS DOUBLE) AS confidence,
  {_q(r.description)} AS description, {ev} AS evidence
FROM flows WHERE {rule_sql(r)}"""
        for i, r in enumerate(rules)]
    body = "\nUNION ALL\n".join(parts) if parts else (
        f"SELECT {IDENT}, 0 AS finding_order, '' AS detector, '' AS rule_id, '' AS name, "
        "'' AS severity, 0.0 AS confidence, '' AS description, '' AS evidence FROM flows WHERE FALSE")
    return [("rule_findings", body)]


def scan_ctes(cfg: DetectionConfig = DEFAULT_CONFIG) -> list[tuple[str, str]]:
    scope = "src_ip" if cfg.across_captures else "capture_id, src_ip"
    w = f"(PARTITION BY {scope} ORDER BY last_seen_us RANGE BETWEEN {cfg.window_us} PRECEDING AND CURRENT ROW)"
    counts = f"""SELECT {IDENT},
  CAST(count(DISTINCT (dst_ip, dst_port)) OVER {w} AS BIGINT) AS distinct_ports,
  CAST(count(DISTINCT dst_ip) OVER {w} AS BIGINT) AS distinct_hosts
FROM flows"""
    p, h, win = cfg.port_scan_threshold, cfg.host_sweep_threshold, float(cfg.scan_window_s)
    findings = f"""SELECT {IDENT}, 1000 AS finding_order, 'signature' AS detector,
  CASE WHEN distinct_ports >= {p} THEN '{PORT_SCAN_ID}' ELSE '{HOST_SWEEP_ID}' END AS rule_id,
  CASE WHEN distinct_ports >= {p} THEN '{PORT_SCAN_NAME}' ELSE '{HOST_SWEEP_NAME}' END AS name,
  CASE WHEN distinct_ports >= {p} THEN 'high' ELSE 'medium' END AS severity,
  CASE WHEN distinct_ports >= {p} THEN least(0.95, 0.5 + CAST(distinct_ports AS DOUBLE) / {2.0 * p!r})
       ELSE least(0.9, 0.4 + CAST(distinct_hosts AS DOUBLE) / {2.0 * h!r}) END AS confidence,
  CASE WHEN distinct_ports >= {p}
       THEN printf('%s touched %d distinct (host, port) pairs in the last %.0fs', src_ip, distinct_ports, {win!r})
       ELSE printf('%s contacted %d distinct hosts in the last %.0fs', src_ip, distinct_hosts, {win!r}) END AS description,
  CASE WHEN distinct_ports >= {p}
       THEN to_json({{'src_ip': src_ip, 'distinct_ports': distinct_ports, 'window_s': {win!r}}})
       ELSE to_json({{'src_ip': src_ip, 'distinct_hosts': distinct_hosts, 'window_s': {win!r}}}) END AS evidence
FROM scan_counts WHERE distinct_ports >= {p} OR distinct_hosts >= {h}"""
    return [("scan_counts", counts), ("scan_findings", findings)]


def detection_ctes(rules: list[Rule], cfg: DetectionConfig = DEFAULT_CONFIG) -> list[tuple[str, str]]:
    """packets -> flows -> findings (rules then scans) -> alerts."""
    findings = """SELECT * FROM rule_findings UNION ALL SELECT * FROM scan_findings"""
    alerts = """SELECT md5(f.flow_id || '|' || f.rule_id) AS id,
  make_timestamp(f.last_seen_us) AS created_at, f.detector, f.rule_id, f.name, f.severity, f.confidence,
  f.description, f.src_ip, f.dst_ip, f.src_port, f.dst_port, f.protocol, coalesce(f.evidence, '{}') AS evidence,
  FALSE AS acknowledged
FROM findings f"""
    return [*packets_ctes(), *flow_ctes(cfg), *rule_findings_ctes(rules), *scan_ctes(cfg),
            ("findings", findings), ("alerts", alerts)]

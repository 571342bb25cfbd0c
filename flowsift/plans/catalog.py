"""Query catalogue: one callable per operator, each (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (or data Spark derives from them) whole: the
packet table is the projection of ``events``; flows, findings and alerts are derived
from it; training rows come from ``lineitem`` and the flows; metric inputs from
``labels`` + ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.config import DEFAULT_CONFIG, FEATURES, DetectionConfig
from flowsift.functions.flags import is_terminator
from flowsift.functions.keys import with_flow_key
from flowsift.operators import alerts as al
from flowsift.operators import findings as fd
from flowsift.operators import flows as fl
from flowsift.operators import rules as ru
from flowsift.operators import scans as sc
from flowsift.sources.events import packets as events_packets
from flowsift.sources.packets import packet_filter
from flowsift.sources.rulefiles import load_rules

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RULE_QUERY_NAMES = {
    "TCP_NULL_SCAN": "rule_null", "TCP_FIN_SCAN": "rule_fin", "TCP_XMAS_SCAN": "rule_xmas",
    "TCP_HALF_OPEN_PROBE": "rule_half_open", "TCP_SYN_FLOOD_FLOW": "rule_syn_flood",
    "ICMP_FLOOD": "rule_icmp_flood", "UDP_FLOOD": "rule_udp_flood",
    "SUSPECTED_DATA_EXFILTRATION": "rule_exfil", "SUSPECTED_C2_BEACONING": "rule_beacon",
}
# acknowledgement log used by the J1 queries: the analyst acknowledges every low-severity
# alert, and also sends ids of flows that carry no such alert (unknown ids)
ACK_RULE = "TCP_HALF_OPEN_PROBE"
# the live buffer and a page of stored alerts that overlaps it in part
FEED_LIVE, FEED_PAGE, FEED_OFFSET = 200, 100, 150


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _packets(spark, sf_dir):
    return events_packets(spark, sf_dir)


def _flows(spark, sf_dir, cfg: DetectionConfig = DEFAULT_CONFIG):
    return fl.flows(_packets(spark, sf_dir), cfg)


def _findings(spark, sf_dir):
    f = _flows(spark, sf_dir)
    return fd.union_findings(ru.rule_findings(f, load_rules()), sc.scan_findings(f))


def alerts_table(spark, sf_dir):
    return fd.alerts_from_findings(_findings(spark, sf_dir))


def acks_table(spark, sf_dir, alerts: DataFrame | None = None, flows: DataFrame | None = None):
    a = alerts_table(spark, sf_dir) if alerts is None else alerts
    f = _flows(spark, sf_dir) if flows is None else flows
    known = a.where(F.col("rule_id") == ACK_RULE).select("id")
    unknown = (f.where(F.col("protocol") == 1)
               .select(F.md5(F.concat_ws("|", "flow_id", F.lit("UNKNOWN"))).alias("id")))
    return known.unionByName(unknown)


def _alerts_and_acks(spark, sf_dir):
    f = _flows(spark, sf_dir)
    a = fd.alerts_from_findings(fd.union_findings(ru.rule_findings(f, load_rules()), sc.scan_findings(f)))
    return a, acks_table(spark, sf_dir, a, f)


# --- packets ----------------------------------------------------------------

@register("packets_keyed")
def packets_keyed(spark, sf_dir):
    p = with_flow_key(_packets(spark, sf_dir))
    return p.select("capture_id", "pkt_idx", "lo_ip", "hi_ip", "lo_port", "hi_port", "protocol",
                    "is_fwd", is_terminator(F.col("tcp_flags")).alias("is_terminator"))


@register("flag_counts")
def flag_counts(spark, sf_dir):
    return fl.keyed_packets(_packets(spark, sf_dir)).select("pkt_idx", *fl.FLAG_FEATURES)


@register("packet_filter")
def packet_filter_q(spark, sf_dir):
    return (packet_filter(_packets(spark, sf_dir), protocol=6, dst_port_max=1023)
            .select("capture_id", "pkt_idx", "ts_us", "src_ip", "dst_ip", "protocol", "src_port", "dst_port",
                    "length", "tcp_flags"))


# --- flows ------------------------------------------------------------------

@register("flow_segments")
def flow_segments(spark, sf_dir):
    s = fl.segment_packets(_packets(spark, sf_dir))
    return s.select("pkt_idx", F.col("seg.pkt_idx").alias("seg_idx"), "is_start",
                    F.col("iat_us").isNotNull().alias("has_iat"),
                    F.coalesce(F.col("iat_us"), F.lit(0)).alias("iat_us"))


@register("flows_idle")
def flows_idle(spark, sf_dir):
    f = fl.flows_no_active(_packets(spark, sf_dir))
    return f.select("flow_id", "first_pkt_idx", "first_seen_us", "last_seen_us", "total_packets",
                    "total_bytes", "close_reason")


@register("flows_active_cut")
def flows_active_cut(spark, sf_dir):
    _, cuts = fl.sessionize(_packets(spark, sf_dir))
    return cuts.select(*fl.KEY, "seg_idx", "cut_idx", "cut_ts")


@register("flows_across_captures")
def flows_across_captures(spark, sf_dir):
    """The packets as three rotated captures of one sensor, each numbered from 0: no flow is cut at a seam."""
    from flowsift.sources.packets import join_captures

    p = _packets(spark, sf_dir)
    lo, hi = p.agg(F.min("pkt_idx"), F.max("pkt_idx")).first()
    width = ((hi or 0) - (lo or 0)) // 3 + 1
    part = F.expr(f"(pkt_idx - {lo or 0}) div {width}")
    rotated = p.withColumn("n", part).withColumn("pkt_idx", F.col("pkt_idx") - (lo or 0) - F.col("n") * width).withColumn(
        "capture_id", F.concat(F.lit("file-"), F.col("n").cast("string"))).drop("n")
    captures = spark.range(3).select(F.concat(F.lit("file-"), F.col("id").cast("string")).alias("capture_id"),
                                     F.lit("events").alias("sensor_id"), F.col("id").alias("seq"))
    f = fl.flows(join_captures(rotated, captures))
    return f.select("src_ip", "dst_ip", "src_port", "dst_port", "protocol", "first_seen_us", "last_seen_us", "close_reason", *FEATURES)


@register("flow_features")
def flow_features(spark, sf_dir):
    return _flows(spark, sf_dir)


_PROJECTIONS = {
    "flow_volume": ["total_packets", "total_bytes", "fwd_packets", "bwd_packets", "fwd_bytes", "bwd_bytes"],
    "flow_lengths": ["fwd_pkt_len_mean", "fwd_pkt_len_std", "fwd_pkt_len_min", "fwd_pkt_len_max",
                     "bwd_pkt_len_mean", "bwd_pkt_len_std", "bwd_pkt_len_min", "bwd_pkt_len_max"],
    "flow_iat": ["iat_mean", "iat_std"],
    "flow_flags": fl.FLAG_FEATURES,
    "flow_identity": ["capture_id", "lo_ip", "hi_ip", "lo_port", "hi_port", "protocol", "src_ip", "dst_ip",
                      "src_port", "dst_port", "first_pkt_idx", "first_seen_us", "last_seen_us", "close_reason"],
    "flow_rates": ["duration_s", "bytes_per_s", "packets_per_s", "down_up_ratio"],
}


def _projection(cols):
    def q(spark, sf_dir):
        return _flows(spark, sf_dir).select("flow_id", *cols)
    return q


for _name, _cols in _PROJECTIONS.items():
    register(_name)(_projection(_cols))


@register("engine_counters")
def engine_counters(spark, sf_dir):
    p = _packets(spark, sf_dir)
    return fl.engine_counters(p, fl.flows(p))


# --- rules ------------------------------------------------------------------

def _single_rule(rule_id):
    def q(spark, sf_dir):
        rule = [r for r in load_rules() if r.id == rule_id]
        return (ru.rule_findings(_flows(spark, sf_dir), rule)
                .select("flow_id", "rule_id", "severity", "confidence"))
    return q


for _rid, _name in RULE_QUERY_NAMES.items():
    register(_name)(_single_rule(_rid))


@register("rule_findings")
def rule_findings(spark, sf_dir):
    return ru.rule_findings(_flows(spark, sf_dir), load_rules())


@register("rule_findings_longform")
def rule_findings_longform(spark, sf_dir):
    return ru.rule_findings_longform(_flows(spark, sf_dir), load_rules())


#: Every operator, and each on a value of another type, an unknown field, no condition.
EDGE_CONDITIONS = {
    "eq": [("total_packets", "eq", 1)], "eq_text": [("total_packets", "eq", "1")], "ne": [("dst_port", "ne", 443)],
    "ne_text": [("dst_port", "ne", "443")], "gt": [("total_bytes", "gt", 60)], "gt_text": [("total_bytes", "gt", "60")],
    "gte": [("total_bytes", "gte", 60)], "lt": [("duration_s", "lt", 0.5)], "lte": [("syn_count", "lte", 1)],
    "in": [("protocol", "in", [1, 17])], "in_mixed": [("dst_port", "in", [22, "80", 53.0, None])], "in_empty": [("protocol", "in", [])],
    "in_scalar": [("protocol", "in", 6)], "eq_true": [("syn_count", "eq", True)], "unknown_field": [("ttl", "eq", 64)],
    "unknown_field_ne": [("ttl", "ne", 64)], "two": [("protocol", "eq", 6), ("fin_count", "gt", 0)], "always": [],
}


def edge_rules():
    from flowsift.sources.rulefiles import Condition, Rule

    return [Rule(name, name, "low", "", tuple(Condition(*c) for c in conditions)) for name, conditions in EDGE_CONDITIONS.items()]


@register("rule_ops_edge_cases")
def rule_ops_edge_cases(spark, sf_dir):
    return ru.rule_findings(_flows(spark, sf_dir), edge_rules()).select("flow_id", "rule_id")


@register("rule_ops_longform")
def rule_ops_longform(spark, sf_dir):
    return ru.rule_findings_longform(_flows(spark, sf_dir), edge_rules()).select("flow_id", "rule_id")


# --- scans ------------------------------------------------------------------

@register("scan_window_counts")
def scan_window_counts(spark, sf_dir):
    return sc.window_counts(_flows(spark, sf_dir)).select("flow_id", "distinct_ports", "distinct_hosts")


@register("scan_findings")
def scan_findings(spark, sf_dir):
    return sc.scan_findings(_flows(spark, sf_dir))


# --- findings and alerts ------------------------------------------------------

@register("all_findings")
def all_findings(spark, sf_dir):
    return _findings(spark, sf_dir)


@register("alerts")
def alerts(spark, sf_dir):
    return alerts_table(spark, sf_dir)


@register("alert_list")
def alert_list(spark, sf_dir):
    return al.list_alerts(alerts_table(spark, sf_dir))


@register("alert_list_filtered")
def alert_list_filtered(spark, sf_dir):
    return al.list_alerts(alerts_table(spark, sf_dir), limit=50, offset=10, severity="medium",
                          detector="signature")


@register("alert_get")
def alert_get(spark, sf_dir):
    """P14 through the alert store: written as one batch, then looked up by id."""
    from flowsift.session import scratch_path
    from flowsift.sources import alertstore as st

    table = scratch_path(spark, "alert-store")
    st.append_alerts(alerts_table(spark, sf_dir), table)
    first_id = st.read_alerts(spark, table).agg(F.min("id")).first()[0]
    return st.lookup(spark, table, first_id)


@register("alert_page_after")
def alert_page_after(spark, sf_dir):
    """O1 by cursor through the alert store: the third page of a hundred."""
    from flowsift.session import scratch_path
    from flowsift.sources import alertstore as st

    table = scratch_path(spark, "alert-store")
    st.append_alerts(alerts_table(spark, sf_dir), table)
    cursor = None
    for _ in range(2):
        last = st.page_after(spark, table, cursor).orderBy(F.asc("created_at"), F.desc("id")).select("created_at", "id").first()
        if last is None:
            break
        cursor = (last.created_at, last.id)
    return st.page_after(spark, table, cursor)


@register("alert_ack_view")
def alert_ack_view(spark, sf_dir):
    a, acks = _alerts_and_acks(spark, sf_dir)
    return al.current_view(a, acks).select("id", "rule_id", "acknowledged")


@register("alert_unknown_acks")
def alert_unknown_acks(spark, sf_dir):
    a, acks = _alerts_and_acks(spark, sf_dir)
    return al.unknown_acks(a, acks)


@register("alert_stats_total")
def alert_stats_total(spark, sf_dir):
    return al.stats_total(alerts_table(spark, sf_dir))


@register("alert_stats_by_severity")
def alert_stats_by_severity(spark, sf_dir):
    return al.stats_by(alerts_table(spark, sf_dir), "severity")


@register("alert_stats_by_detector")
def alert_stats_by_detector(spark, sf_dir):
    return al.stats_by(alerts_table(spark, sf_dir), "detector")


@register("alert_stats_top_sources")
def alert_stats_top_sources(spark, sf_dir):
    return al.top_sources(alerts_table(spark, sf_dir))


@register("alert_stats_combined")
def alert_stats_combined(spark, sf_dir):
    return al.stats_grouping_sets(alerts_table(spark, sf_dir))


@register("alert_stats_nested")
def alert_stats_nested(spark, sf_dir):
    nested = al.stats(alerts_table(spark, sf_dir))
    return nested.select(F.to_json(F.struct("total", "by_severity", "by_detector", "top_src_ips")).alias("stats"))


@register("severity_share")
def severity_share(spark, sf_dir):
    return al.severity_share(alerts_table(spark, sf_dir))


@register("notify_payloads")
def notify_payloads(spark, sf_dir):
    return al.notify_payloads(alerts_table(spark, sf_dir), "high")


@register("live_payloads")
def live_payloads(spark, sf_dir):
    return al.live_payloads(alerts_table(spark, sf_dir))


@register("live_latest")
def live_latest(spark, sf_dir):
    return al.latest(alerts_table(spark, sf_dir)).select("id", "created_at", "rule_id")


@register("console_lines")
def console_lines(spark, sf_dir):
    from flowsift.sources.alertstore import console_lines as lines

    a = alerts_table(spark, sf_dir)
    return lines(a).select("id", F.col("value").alias("line"))


@register("feed_merge")
def feed_merge(spark, sf_dir):
    a = alerts_table(spark, sf_dir)
    live = al.latest(a, FEED_LIVE)
    persisted = al.list_alerts(a, limit=FEED_PAGE, offset=FEED_OFFSET)
    return al.feed_merge(live, persisted).select("id", "origin")


@register("alert_rows_formatted")
def alert_rows_formatted(spark, sf_dir):
    return al.formatted_rows(alerts_table(spark, sf_dir))


@register("alert_counts_by_rule")
def flagship(spark, sf_dir):
    """The flagship: packets -> flows -> rules + scan detector -> alerts per rule."""
    return alerts_table(spark, sf_dir).groupBy("rule_id", "severity").agg(F.count("id").alias("n_alerts"))


# --- training data, split, scaling --------------------------------------------

def _csv_rows(spark, sf_dir):
    from flowsift.sources.cicflow import lineitem_as_flow_csv
    from flowsift.sources.events import read_table

    return lineitem_as_flow_csv(read_table(spark, sf_dir, "lineitem"))


@register("training_map")
def training_map(spark, sf_dir):
    from flowsift.sources.cicflow import map_columns

    return map_columns(_csv_rows(spark, sf_dir), source="lineitem")


@register("label_binarise")
def label_binarise(spark, sf_dir):
    return training_map(spark, sf_dir).groupBy("label_detail", "label").agg(F.count(F.lit(1)).alias("n"))


@register("training_clean")
def training_clean(spark, sf_dir):
    from flowsift.sources.cicflow import clean

    return clean(training_map(spark, sf_dir))


def _labelled(spark, sf_dir):
    from flowsift.operators.training import labelled_flows

    f = _flows(spark, sf_dir)
    return labelled_flows(f, fd.union_findings(ru.rule_findings(f, load_rules()), sc.scan_findings(f)))


@register("split_stratified")
def split_stratified(spark, sf_dir):
    from flowsift.operators.training import stratified_split

    return stratified_split(_labelled(spark, sf_dir), "flow_id").select("flow_id", "label", "split")


def _sci(c):
    return F.format_string("%.9e", F.col(c))


@register("scaler_params")
def scaler_params(spark, sf_dir):
    from flowsift.operators.training import benign_train, scaler_params as sp, stratified_split

    tr = benign_train(stratified_split(_labelled(spark, sf_dir), "flow_id"))
    return sp(tr).select("pos", "feature", _sci("mean").alias("mean"), _sci("std").alias("std"),
                         _sci("scale").alias("scale"))


# --- scores and metrics (labels + documents) -----------------------------------

def _labelled_docs(spark, sf_dir):
    from flowsift.sources.events import read_table

    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lab.join(docs, "doc_id")


def _unit_docs(spark, sf_dir):
    from flowsift.operators.metrics import unit_score

    return unit_score(_labelled_docs(spark, sf_dir), "n_chars", "score")


@register("score_minmax")
def score_minmax(spark, sf_dir):
    return _unit_docs(spark, sf_dir).select("doc_id", "label", "score")


@register("calibration_bounds")
def calibration_bounds_q(spark, sf_dir):
    from flowsift.operators.metrics import calibration_bounds

    d = _labelled_docs(spark, sf_dir).where(F.col("label") == 1)
    lo, hi = calibration_bounds(d, "n_chars")
    return d.agg(F.count(F.lit(1)).alias("n")).select(
        "n", F.lit(lo).cast("double").alias("lo"), F.lit(hi).cast("double").alias("hi"))


@register("calibrated_scores")
def calibrated_scores(spark, sf_dir):
    from flowsift.operators.metrics import calibrate, calibration_bounds, severity_band

    d = _labelled_docs(spark, sf_dir)
    lo, hi = calibration_bounds(d.where(F.col("label") == 1), "n_chars")
    s = calibrate(F.col("n_chars"), lo, hi)
    return d.select("doc_id", s.alias("score"), severity_band(s).alias("severity"))


@register("severity_bands")
def severity_bands(spark, sf_dir):
    return calibrated_scores(spark, sf_dir).groupBy("severity").agg(F.count(F.lit(1)).alias("n"))


@register("roc_auc")
def roc_auc_q(spark, sf_dir):
    from flowsift.operators.metrics import roc_auc

    return roc_auc(_unit_docs(spark, sf_dir), "score", "label")


@register("average_precision")
def average_precision_q(spark, sf_dir):
    from flowsift.operators.metrics import average_precision

    return average_precision(_unit_docs(spark, sf_dir), "score", "label").select(
        _sci("average_precision").alias("average_precision"))


@register("classification_report")
def classification_report_q(spark, sf_dir):
    from flowsift.operators.metrics import classification_report

    return classification_report(_unit_docs(spark, sf_dir), "score", "label")


# --- isolation forest ------------------------------------------------------------

def _flow_model(spark, sf_dir, flows):
    """(model fitted on the benign training flows, labelled flows)."""
    from flowsift.operators import iforest as ifo
    from flowsift.operators.training import benign_train, labelled_flows, stratified_split
    from flowsift.session import materialize

    found = fd.union_findings(ru.rule_findings(flows, load_rules()), sc.scan_findings(flows))
    lab = materialize(labelled_flows(flows, found), "labelled-flows")
    train = materialize(benign_train(stratified_split(lab, "flow_id"))
                        .select("flow_id", ifo.feature_vector().alias("x")), "iforest-train")
    model = ifo.fit(train, "flow_id", feature_names=list(FEATURES))
    scored = materialize(ifo.score_frame(train, model).select("raw_score"), "iforest-train-scores")
    return ifo.calibrate_model(model, scored), lab


@register("iforest_scores")
def iforest_scores(spark, sf_dir):
    from flowsift.operators import iforest as ifo
    from flowsift.operators.metrics import calibrate

    model, lab = _flow_model(spark, sf_dir, _flows(spark, sf_dir))
    scored = ifo.score_frame(lab.select("flow_id", "label", ifo.feature_vector().alias("x")), model)
    scored = scored.withColumn("score", calibrate(F.col("raw_score"), model.calib_lo, model.calib_hi))
    return scored.select("flow_id", "label", _sci("raw_score").alias("raw_score"), _sci("score").alias("score"))


@register("anomaly_findings")
def anomaly_findings(spark, sf_dir):
    from flowsift.operators import iforest as ifo

    f = _flows(spark, sf_dir)
    model, _ = _flow_model(spark, sf_dir, f)
    return ifo.anomaly_findings(f, model).withColumn("confidence", F.round("confidence", 9))


@register("train_report")
def train_report(spark, sf_dir):
    """The training run on the labelled flows; its report is read back from the saved model."""
    from flowsift.operators import iforest as ifo
    from flowsift.operators.training import training_run
    from flowsift.session import scratch_path

    path = scratch_path(spark, "model")
    training_run(_labelled(spark, sf_dir), "flow_id").save(spark, path)
    saved = ifo.IForestModel.load(spark, path, expect_features=list(FEATURES)).metadata["report"]
    return spark.createDataFrame(list(saved.items()), "name string, value double").select("name", _sci("value").alias("value"))


@register("iforest_embeddings")
def iforest_embeddings(spark, sf_dir):
    from flowsift.operators import iforest as ifo
    from flowsift.sources.events import read_table

    emb = read_table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    model = ifo.fit(emb.where(F.col("label") == 0), "vec_id")
    return ifo.score_frame(emb, model).select("vec_id", "label", _sci("raw_score").alias("raw_score"))


# --- streaming (T1op-T6op): equal to the batch oracle ----------------------------

STREAM_FLOW_COLUMNS = [c for c in fl.FLOW_COLUMNS if c != "close_reason"]


MICRO_BATCHES = 5


def _in_files(rows: DataFrame, time_col: str, path: str) -> str:
    """Stand-in for a growing folder: the rows in ``MICRO_BATCHES`` files, older times in older files."""
    lo, hi = rows.agg(F.min(time_col), F.max(time_col)).first()
    width = ((hi or 0) - (lo or 0)) // MICRO_BATCHES + 1
    for i in range(MICRO_BATCHES):
        at = (lo or 0) + i * width
        part = rows.where((F.col(time_col) >= at) & (F.col(time_col) < at + width))
        part.repartition(1).write.mode("append").parquet(path)  # read by all tasks, written by one
    return path


@register("stream_flows")
def stream_flows_q(spark, sf_dir):
    """The flow tracker over several micro-batches, a file each."""
    from flowsift.session import scratch_path
    from flowsift.streaming.flows import run_to_end

    pk = _in_files(_packets(spark, sf_dir), "ts_us", scratch_path(spark, "stream-packets"))
    out = run_to_end(spark, pk, scratch_path(spark, "stream-flows"), scratch_path(spark, "stream-ckpt"), max_files_per_trigger=1)
    return out.select(*STREAM_FLOW_COLUMNS)


@register("stream_flows_late")
def stream_flows_late(spark, sf_dir):
    """T6op: packets that come a file too late go to the side table; the flows are corrected afterwards."""
    from flowsift.session import scratch_path
    from flowsift.streaming import late
    from flowsift.streaming.flows import run_to_end

    p = _packets(spark, sf_dir)
    top = (p.agg(F.max("pkt_idx")).first()[0] or 0) + 1
    width = top // MICRO_BATCHES + 1
    # packets arrive in the order of their numbers, but every fortieth or so a file later
    file = F.expr(f"pkt_idx div {width}") + F.when(F.xxhash64("pkt_idx") % 40 == 0, 1).otherwise(0)
    pk = scratch_path(spark, "stream-packets")
    for i in range(MICRO_BATCHES + 1):
        p.where(file == i).repartition(1).write.mode("append").parquet(pk)
    dealt = scratch_path(spark, "stream-dealt")
    lateness = 900  # the table's packet kinds run on clocks of their own, up to twelve minutes apart
    late.split_late(spark, pk, dealt, scratch_path(spark, "stream-deal-ckpt"), lateness, max_files_per_trigger=1)
    flows = run_to_end(spark, f"{dealt}/on_time/*", scratch_path(spark, "stream-flows"), scratch_path(spark, "stream-ckpt"),
                       max_files_per_trigger=1, lateness_s=lateness)
    out = late.corrected_flows(flows, late.dealt(spark, dealt, "on_time"), late.dealt(spark, dealt, "late"))
    return out.select(*STREAM_FLOW_COLUMNS)


@register("stream_scans")
def stream_scans_q(spark, sf_dir):
    """The scan state alone, over the flow table in several micro-batches."""
    from flowsift.session import scratch_path
    from flowsift.streaming.alerts import run_scans_to_end

    f = _in_files(_flows(spark, sf_dir), "last_seen_us", scratch_path(spark, "stream-flow-files"))
    return run_scans_to_end(spark, f, scratch_path(spark, "stream-scans"), scratch_path(spark, "stream-scans-ckpt"),
                            max_files_per_trigger=1)


@register("stream_alerts")
def stream_alerts_q(spark, sf_dir):
    """Packets -> flow stream -> (rules + scan state) stream -> alert store, end to end, in several micro-batches."""
    from flowsift.session import scratch_path
    from flowsift.streaming.alerts import run_detection_to_end
    from flowsift.streaming.flows import run_to_end

    pk = _in_files(_packets(spark, sf_dir), "ts_us", scratch_path(spark, "stream-packets"))
    flows = run_to_end(spark, pk, scratch_path(spark, "stream-flow-sink"), scratch_path(spark, "stream-ckpt"), max_files_per_trigger=1)
    flows_dir = _in_files(flows, "last_seen_us", scratch_path(spark, "stream-flows"))
    return run_detection_to_end(spark, flows_dir, scratch_path(spark, "stream-alerts"),
                                scratch_path(spark, "stream-alerts-ckpt"), load_rules(), max_files_per_trigger=1)


@register("training_metadata")
def training_metadata_q(spark, sf_dir):
    from flowsift.operators.training import stratified_split, training_metadata

    return training_metadata(stratified_split(_labelled(spark, sf_dir), "flow_id"))


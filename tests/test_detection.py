from conftest import OFFICE, make_packets, office_capture_rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowsift.config import DetectionConfig
from flowsift.operators import flows as fl
from flowsift.operators import scans as sc
from flowsift.plans.detect import detect


def test_office_capture_end_to_end(spark):
    p = make_packets(spark, office_capture_rows(), capture_id="office")
    d = detect(p)
    assert d.flows.count() == OFFICE["flows"]
    counts = {r.rule_id: r["count"] for r in d.findings.groupBy("rule_id").count().collect()}
    assert counts == OFFICE["findings"]
    assert d.alerts.where(F.col("dst_port") == 8443).count() == 0
    hs = d.flows.where(F.col("dst_port") == 8443).first()
    assert (hs.total_packets, hs.fwd_packets, hs.bwd_packets, hs.total_bytes) == (10, 5, 5, 540)
    assert (hs.syn_count, hs.ack_count, hs.fin_count, hs.psh_count) == (2, 9, 1, 3)


def _one_packet_flows(spark, times_ports):
    rows = [(t, "10.0.0.1", "10.0.0.9", 40000 + i, port, "S", 6, 60) for i, (t, port) in enumerate(times_ports)]
    return fl.flows(make_packets(spark, rows))


def test_scan_detector_thresholds(spark):
    f = _one_packet_flows(spark, [(float(p), p) for p in range(1, 15)])
    cfg = DetectionConfig(port_scan_threshold=10, host_sweep_threshold=100)
    s = sc.scan_findings(f, cfg).collect()
    assert len(s) == 5 and {r.rule_id for r in s} == {"HOST_PORT_SCAN"}
    f2 = _one_packet_flows(spark, [(float(i + 1), 443) for i in range(5)])
    assert sc.scan_findings(f2).count() == 0
    f3 = _one_packet_flows(spark, [(0.5, 1), (1.0, 2), (100.0, 3)])
    assert sc.scan_findings(f3, DetectionConfig(scan_window_s=5, port_scan_threshold=3)).count() == 0


def test_interval_counts_equal_brute_force(spark):
    from conftest import SF0001
    from flowsift.sources.events import packets as events_packets

    f = fl.flows(events_packets(spark, SF0001))
    w = Window.partitionBy("capture_id", "src_ip").orderBy("last_seen_us").rangeBetween(-30_000_000, 0)
    bf = f.select("flow_id", F.size(F.collect_set(F.struct("dst_ip", "dst_port")).over(w)).cast("long").alias("p"),
                  F.size(F.collect_set("dst_ip").over(w)).cast("long").alias("h"))
    for cfg in (DetectionConfig(), DetectionConfig(scan_time_bucket_us=100_000_000)):
        ours = sc.window_counts(f, cfg).select("flow_id", F.col("distinct_ports").alias("p"), F.col("distinct_hosts").alias("h"))
        assert bf.exceptAll(ours).count() == 0 and ours.exceptAll(bf).count() == 0

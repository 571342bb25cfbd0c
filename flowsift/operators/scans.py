"""Cross-flow scan detector (W1-W5): distinct targets per source in a sliding window.

For every flow, count the distinct (dst_ip, dst_port) pairs and distinct dst_ip that
its source touched in the closed window ``[last_seen - w, last_seen]`` (all flows of
the source whose ``last_seen`` falls in it, the flow itself included).

``COUNT(DISTINCT ...) OVER (RANGE ...)`` is not available in Spark, and a per-row set
(``collect_set`` over the frame) grows with the window. Instead, interval events: each
occurrence of a target at time x covers ``[x, min(x + w, next occurrence))``; the running
sum of +1 at x and -1 at the cover's end is the number of distinct targets.

Time is cut into buckets a little wider than the window, and every flow is handed to its own
bucket and to the next one. A bucket then holds all that its flows' windows reach, the next
occurrence of each target included, so both ``lead`` scans and the running sum stay inside
(scope, bucket): one exchange, one pass over the flows, no stitching, and a hot source is
spread over as many tasks as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.config import (
    DEFAULT_CONFIG, DETECTOR_SIGNATURE, HOST_SWEEP_ID, HOST_SWEEP_NAME, PORT_SCAN_ID,
    PORT_SCAN_NAME, DetectionConfig,
)

SCAN_FINDING_ORDER = 1000  # after every signature rule, before the anomaly finding
# flow identity carried by every finding, so alerts need no join back to flows
IDENTITY = ("flow_id", "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "last_seen_us")


def _scope(cfg: DetectionConfig) -> list[str]:
    return ["src_ip"] if cfg.across_captures else ["capture_id", "src_ip"]


def window_counts(flows: DataFrame, cfg: DetectionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Per flow, ``distinct_ports`` and ``distinct_hosts`` in the sliding window."""
    scope = _scope(cfg)
    cover = cfg.window_us + 1  # both ends of the window count
    width = max(cover, int(cfg.scan_time_bucket_us))
    rest = [c for c in IDENTITY if c not in scope]
    own = F.expr(f"last_seen_us div {width}")
    f = flows.select(*scope, *rest, "first_pkt_idx", F.explode(F.array(
        F.struct(own.alias("bucket"), F.lit(True).alias("asks")),
        F.struct((own + 1).alias("bucket"), F.lit(False).alias("asks")))).alias("b"))
    f = f.select(*scope, *rest, "first_pkt_idx", "b.bucket", "b.asks")
    place = [*scope, "bucket"]
    f = f.repartition(*place)

    t = F.col("last_seen_us")

    def covered(target: list[str]) -> Column:
        following = Window.partitionBy(*place, *target).orderBy(t, "first_pkt_idx")
        return F.least(t + cover, F.coalesce(F.lead(t).over(following), t + cover))

    f = f.withColumn("ports_end", covered(["dst_ip", "dst_port"])).withColumn("hosts_end", covered(["dst_ip"]))
    probe = F.when(F.col("asks"), F.struct(*rest))

    def event(at: Column, ports: int, hosts: int, flow: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(ports).alias("ports"), F.lit(hosts).alias("hosts"), flow.alias("flow"))

    none = F.when(F.lit(False), F.struct(*rest))
    e = f.select(*place, F.explode(F.array(
        event(t, 1, 1, probe), event(F.col("ports_end"), -1, 0, none), event(F.col("hosts_end"), 0, -1, none))).alias("e"))
    running = Window.partitionBy(*place).orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    e = e.select(*place, "e.*").select(
        *scope, "flow", F.sum("ports").over(running).alias("distinct_ports"), F.sum("hosts").over(running).alias("distinct_hosts"))
    return e.where(F.col("flow").isNotNull()).select(
        *[c for c in scope if c != "capture_id"], "flow.*", "distinct_ports", "distinct_hosts")


def scan_findings(flows: DataFrame, cfg: DetectionConfig = DEFAULT_CONFIG,
                  counts: DataFrame | None = None) -> DataFrame:
    """A port scan when ports >= threshold, else a host sweep when hosts >= threshold;
    at most one finding per flow, re-fired on every further qualifying flow."""
    counts = window_counts(flows, cfg) if counts is None else counts
    p, h = cfg.port_scan_threshold, cfg.host_sweep_threshold
    win = F.lit(float(cfg.scan_window_s))
    j = counts
    ports, hosts = F.col("distinct_ports"), F.col("distinct_hosts")
    is_port = ports >= p
    is_host = ~is_port & (hosts >= h)
    port_struct = F.struct(
        F.lit(PORT_SCAN_ID).alias("rule_id"), F.lit(PORT_SCAN_NAME).alias("name"),
        F.lit("high").alias("severity"),
        F.least(F.lit(0.95), F.lit(0.5) + ports.cast("double") / F.lit(2.0 * p)).alias("confidence"),
        F.format_string("%s touched %d distinct (host, port) pairs in the last %.0fs",
                        F.col("src_ip"), ports, win).alias("description"),
        F.to_json(F.struct(F.col("src_ip"), ports.alias("distinct_ports"), win.alias("window_s"))).alias("evidence"))
    host_struct = F.struct(
        F.lit(HOST_SWEEP_ID).alias("rule_id"), F.lit(HOST_SWEEP_NAME).alias("name"),
        F.lit("medium").alias("severity"),
        F.least(F.lit(0.9), F.lit(0.4) + hosts.cast("double") / F.lit(2.0 * h)).alias("confidence"),
        F.format_string("%s contacted %d distinct hosts in the last %.0fs",
                        F.col("src_ip"), hosts, win).alias("description"),
        F.to_json(F.struct(F.col("src_ip"), hosts.alias("distinct_hosts"), win.alias("window_s"))).alias("evidence"))
    f: Column = F.when(is_port, port_struct).when(is_host, host_struct)
    return (j.where(is_port | is_host).select(*IDENTITY, f.alias("f"))
            .select(*IDENTITY, F.lit(SCAN_FINDING_ORDER).alias("finding_order"),
                    F.lit(DETECTOR_SIGNATURE).alias("detector"), "f.rule_id", "f.name", "f.severity",
                    "f.confidence", "f.description", "f.evidence"))

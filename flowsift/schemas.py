"""Explicit schemas: packets, flows, findings, alerts. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

from flowsift.config import FEATURES

PACKETS = T.StructType([
    T.StructField("capture_id", T.StringType(), False),
    T.StructField("pkt_idx", T.LongType(), False),
    T.StructField("ts_us", T.LongType(), False),
    T.StructField("src_ip", T.StringType(), False),
    T.StructField("dst_ip", T.StringType(), False),
    T.StructField("protocol", T.IntegerType(), False),
    T.StructField("src_port", T.IntegerType(), True),
    T.StructField("dst_port", T.IntegerType(), True),
    T.StructField("length", T.LongType(), False),
    T.StructField("ttl", T.IntegerType(), True),
    T.StructField("tcp_flags", T.StringType(), True),
    T.StructField("payload_len", T.IntegerType(), True),
])

FLOW_KEY = ("capture_id", "lo_ip", "hi_ip", "lo_port", "hi_port", "protocol")

_COUNT_FEATURES = {"total_packets", "total_bytes", "fwd_packets", "bwd_packets", "fwd_bytes",
                   "bwd_bytes", "syn_count", "ack_count", "fin_count", "rst_count", "psh_count",
                   "urg_count"}

FLOWS = T.StructType(
    [
        T.StructField("flow_id", T.StringType(), False),
        T.StructField("capture_id", T.StringType(), False),
        T.StructField("lo_ip", T.StringType(), False),
        T.StructField("hi_ip", T.StringType(), False),
        T.StructField("lo_port", T.IntegerType(), False),
        T.StructField("hi_port", T.IntegerType(), False),
        T.StructField("protocol", T.IntegerType(), False),
        T.StructField("src_ip", T.StringType(), False),
        T.StructField("dst_ip", T.StringType(), False),
        T.StructField("src_port", T.IntegerType(), False),
        T.StructField("dst_port", T.IntegerType(), False),
        T.StructField("first_pkt_idx", T.LongType(), False),
        T.StructField("first_seen_us", T.LongType(), False),
        T.StructField("last_seen_us", T.LongType(), False),
        T.StructField("close_reason", T.StringType(), False),
    ]
    + [T.StructField(f, T.LongType() if f in _COUNT_FEATURES else T.DoubleType(), False)
       for f in FEATURES]
)

FINDING_FIELDS = ("flow_id", "detector", "rule_id", "name", "severity", "confidence",
                  "description", "evidence")

ALERTS = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("created_at", T.TimestampNTZType(), False),  # UTC wall clock
    T.StructField("detector", T.StringType(), False),
    T.StructField("rule_id", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("confidence", T.DoubleType(), False),
    T.StructField("description", T.StringType(), False),
    T.StructField("src_ip", T.StringType(), False),
    T.StructField("dst_ip", T.StringType(), False),
    T.StructField("src_port", T.IntegerType(), False),
    T.StructField("dst_port", T.IntegerType(), False),
    T.StructField("protocol", T.IntegerType(), False),
    T.StructField("evidence", T.StringType(), False),
    T.StructField("acknowledged", T.BooleanType(), False),
])

ACKS = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("acked_at", T.TimestampType(), False),
])

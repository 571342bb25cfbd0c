"""Deterministic packet projection of the driver's ``events`` table.

Every event becomes one packet. The mapping is a pure per-row projection (no
shuffle), so it scales with the events table and fuses into the scan stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_CAPTURE_ID = "events"


def packets_from_events(events: DataFrame) -> DataFrame:
    """Project ``events(event_id, ts, user_id, event_type, value, props)`` to packets.

    click -> ICMP, purchase -> SYN-heavy TCP bulk, signup -> TCP conversation,
    view -> UDP, error -> TCP scan probes (SURVEY §7.3).
    """
    e, u, k, d = F.col("event_type"), F.col("user_id"), F.col("k"), F.col("d_us")
    click, purchase, signup, view, error = (e == x for x in
                                            ("click", "purchase", "signup", "view", "error"))
    even_u = (u % 2) == 0
    u_div_50 = F.expr("user_id div 50").cast("string")

    ts_us = (F.when(click, F.expr("d_us div 100000"))
             .when(purchase, F.expr("d_us div 36000"))
             .otherwise(F.expr("d_us div 3600")))
    ip_a = (F.when(click, F.lit("10.0.1.1"))
            .when(purchase, F.concat(F.lit("10.0.2."), (u % 2).cast("string")))
            .when(signup, F.concat(F.lit("10.0.3."), u_div_50))
            .when(view, F.concat(F.lit("10.0.4."), (u % 5).cast("string")))
            .when(even_u, F.concat(F.lit("203.0.113."), u_div_50))
            .otherwise(F.concat(F.lit("198.51.100."), u_div_50)))
    ip_b = (F.when(error & ~even_u, F.concat(F.lit("9.9.10."), (k % 18).cast("string")))
            .otherwise(F.lit("9.9.9.1")))
    port_a = (F.when(click, F.lit(None))
              .when(purchase | signup, F.lit(50000))
              .when(view, F.when(k < 10, F.lit(51000) + u * 10 + k).otherwise(F.lit(50000)))
              .otherwise(F.lit(40000) + k)).cast("int")
    port_b = (F.when(click, F.lit(None))
              .when(purchase | signup, F.lit(443))
              .when(view, F.lit(53))
              .when(even_u, k)
              .otherwise(F.lit(22))).cast("int")
    reverse = (signup | view) & ((k % 2) == 1)
    length = F.when(purchase, F.lit(60000) + F.floor("value")).otherwise(F.lit(54) + F.floor("value"))
    flags = (F.when(click | view, F.lit(None).cast("string"))
             .when(purchase, F.when(k == 0, F.lit("FA")).otherwise(F.lit("S")))
             .when(signup, F.when(k == 0, F.lit("FA")).when(k < 50, F.lit("PA")).otherwise(F.lit("A")))
             .when((k % 4) == 0, F.lit(""))
             .when((k % 4) == 1, F.lit("S"))
             .when((k % 4) == 2, F.lit("F"))
             .otherwise(F.lit("FPU")))
    protocol = F.when(click, F.lit(1)).when(view, F.lit(17)).otherwise(F.lit(6))

    return (
        events.select(
            "event_id", "user_id", "event_type", "value",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            # microseconds since 2024-01-01 (ts is TIMESTAMP_NTZ: no time zone involved)
            F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)").alias("d_us"),
        )
        .select(
            F.lit(EVENTS_CAPTURE_ID).alias("capture_id"),
            F.col("event_id").cast("long").alias("pkt_idx"),
            ts_us.cast("long").alias("ts_us"),
            F.when(reverse, ip_b).otherwise(ip_a).alias("src_ip"),
            F.when(reverse, ip_a).otherwise(ip_b).alias("dst_ip"),
            protocol.cast("int").alias("protocol"),
            F.when(reverse, port_b).otherwise(port_a).alias("src_port"),
            F.when(reverse, port_a).otherwise(port_b).alias("dst_port"),
            length.cast("long").alias("length"),
            F.lit(None).cast("int").alias("ttl"),
            flags.alias("tcp_flags"),
            F.lit(0).alias("payload_len"),
        )
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packet table derived from ``events`` at one scale factor."""
    return packets_from_events(read_table(spark, sf_dir, "events"))

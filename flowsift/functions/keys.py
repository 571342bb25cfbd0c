"""Flow-key columns (P1, P2) and the protocol classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def port0(c: str | Column) -> Column:
    """Ports are nullable; keys and flows treat a missing port as 0."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0))


def is_forward(src_ip="src_ip", dst_ip="dst_ip", src_port="src_port", dst_port="dst_port") -> Column:
    """True when (src_ip, src_port) <= (dst_ip, dst_port) lexicographically (text, then int).

    Endpoint order, not initiator order: 9.0.0.1 sorts after 10.0.0.1.
    """
    s, d = F.col(src_ip), F.col(dst_ip)
    return (s < d) | ((s == d) & (port0(src_port) <= port0(dst_port)))


def with_flow_key(packets, fwd_col: str = "is_fwd"):
    """Add canonical lo/hi endpoint columns plus the direction flag."""
    fwd = F.col(fwd_col)
    return (
        packets.withColumn(fwd_col, is_forward())
        .withColumn("lo_ip", F.when(fwd, F.col("src_ip")).otherwise(F.col("dst_ip")))
        .withColumn("hi_ip", F.when(fwd, F.col("dst_ip")).otherwise(F.col("src_ip")))
        .withColumn("lo_port", F.when(fwd, port0("src_port")).otherwise(port0("dst_port")))
        .withColumn("hi_port", F.when(fwd, port0("dst_port")).otherwise(port0("src_port")))
    )

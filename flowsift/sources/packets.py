"""Packet tables (S1) and the capture filter re-aimed as a pushed-down predicate (P5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowsift.schemas import PACKETS


def read_packets(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A capture-agnostic packet table with the fixed schema (never inferred)."""
    reader = spark.read.schema(PACKETS)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def stream_packets(spark: SparkSession, path: str, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """S3: packets arriving as files (sensors write packet rows; Spark opens no NIC).
    ``maxFilesPerTrigger`` bounds a micro-batch instead of dropping packets."""
    r = spark.readStream.schema(PACKETS).format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def packet_filter(packets: DataFrame, protocol: int | None = None, host: str | None = None,
                  port: int | None = None, dst_port_max: int | None = None,
                  where: str | Column | None = None) -> DataFrame:
    """P5: keep packets matching every given predicate. Plain column predicates, so Parquet
    receives them as pushed filters; ``where`` takes any Spark SQL predicate."""
    preds: list[Column] = []
    if protocol is not None:
        preds.append(F.col("protocol") == protocol)
    if host is not None:
        preds.append((F.col("src_ip") == host) | (F.col("dst_ip") == host))
    if port is not None:
        preds.append((F.col("src_port") == port) | (F.col("dst_port") == port))
    if dst_port_max is not None:
        preds.append(F.col("dst_port") <= dst_port_max)
    if where is not None:
        preds.append(F.expr(where) if isinstance(where, str) else where)
    return packets.where(reduce(lambda a, b: a & b, preds)) if preds else packets


def join_captures(packets: DataFrame, captures: DataFrame) -> DataFrame:
    """G1 across captures: the packets of a sensor's successive captures as one capture of that sensor.

    ``captures``: (capture_id, sensor_id, seq), the order in which a sensor's files were written. A capture's
    packets keep their order and are numbered after those of the captures before it, so flows, cuts and scan
    windows run over the seams of rotated files. Captures that are not listed stay as they are. Sizes of the captures come
    from one partial-aggregated maximum; the table of offsets has a row for each capture."""
    sizes = packets.groupBy("capture_id").agg((F.max("pkt_idx") + 1).alias("n"))
    order = Window.partitionBy("sensor_id").orderBy("seq", "capture_id").rowsBetween(Window.unboundedPreceding, -1)
    offsets = captures.join(sizes, "capture_id").select(
        "capture_id", "sensor_id", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    joined = packets.join(offsets, "capture_id", "left")
    return joined.withColumn("pkt_idx", F.col("pkt_idx") + F.coalesce("before", F.lit(0))).withColumn(
        "capture_id", F.coalesce("sensor_id", "capture_id")).select(*packets.columns)

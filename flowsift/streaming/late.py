"""Late packets (T6op): a side table for them, and a run that corrects the flows they belong to.

``split_late`` goes in front of the flow stream. The flow tracker takes a capture's packets in the
order of their numbers (``pkt_idx``), so a packet is late if a packet of its capture with a higher number
came in an earlier micro-batch, or if its time lies by the lateness or more behind the newest one of
earlier micro-batches (the watermark would drop it). Late packets go to the side table, the others on to
the flow stream, as one file for a micro-batch: several would be taken one after the other, each with packets
of the others' numbers and times. The highest numbers and newest times of each micro-batch are a table of their own; its
part for a micro-batch is written last, and a replayed micro-batch that has it is left alone.

``corrected_flows`` sessionizes again only the flow keys that have late packets, from all of their
packets, and puts the outcome in the place of those keys' flows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.config import DEFAULT_CONFIG, DetectionConfig
from flowsift.functions.keys import with_flow_key
from flowsift.operators import flows as fl
from flowsift.schemas import PACKETS
from flowsift.session import parquet_if_there
from flowsift.sources.packets import stream_packets
from flowsift.streaming.flows import run_available

SEEN = "batch long, capture_id string, last_idx long, newest_us long"


def split_late(spark: SparkSession, packets_dir: str, out_dir: str, checkpoint: str, lateness_s: int,
               max_files_per_trigger: int | None = None, progress: list[dict] | None = None) -> None:
    """Deals the packet files into ``<out_dir>/on_time/<n>`` and ``<out_dir>/late/<n>``, n being the micro-batch."""
    def deal(batch: DataFrame, n: int) -> None:
        session = batch.sparkSession
        seen = parquet_if_there(session, f"{out_dir}/seen/*", SEEN)
        rows, late = batch, F.lit(False)
        if seen is not None:
            if not seen.where(F.col("batch") == n).isEmpty():
                return
            seen = seen.where(F.col("batch") < n)
            newest = seen.agg(F.max("newest_us")).first()[0]
            if newest is not None:
                last = seen.groupBy("capture_id").agg(F.max("last_idx").alias("last_idx"))
                rows = batch.join(last, "capture_id", "left")
                late = F.coalesce(F.col("pkt_idx") < F.col("last_idx"), F.lit(False)) | F.coalesce(
                    F.col("ts_us") <= newest - int(lateness_s) * 1_000_000, F.lit(False))
        name = f"{n:09d}"
        rows.where(~late).select(*batch.columns).repartition(1).write.mode("overwrite").parquet(f"{out_dir}/on_time/{name}")
        rows.where(late).select(*batch.columns).write.mode("overwrite").parquet(f"{out_dir}/late/{name}")
        newest = batch.groupBy("capture_id").agg(F.max("pkt_idx").alias("last_idx"), F.max("ts_us").alias("newest_us"))
        newest.select(F.lit(n).cast("long").alias("batch"), "capture_id", "last_idx", "newest_us").write.mode(
            "overwrite").parquet(f"{out_dir}/seen/{name}")

    src = stream_packets(spark, packets_dir, max_files_per_trigger=max_files_per_trigger)
    writer = src.writeStream.foreachBatch(deal).option("checkpointLocation", checkpoint)
    run_available(spark, writer, [] if progress is None else progress)


def dealt(spark: SparkSession, out_dir: str, kind: str) -> DataFrame:
    """The packets dealt so far as ``on_time`` or ``late``."""
    found = parquet_if_there(spark, f"{out_dir}/{kind}/*", PACKETS)
    return spark.createDataFrame([], PACKETS) if found is None else found


def corrected_flows(flows: DataFrame, on_time: DataFrame, late: DataFrame, cfg: DetectionConfig = DEFAULT_CONFIG) -> DataFrame:
    """``flows`` (of the on-time packets) as they are with the late packets in their places. Only keys with late
    packets are read again and sessionized."""
    keys = with_flow_key(late).select(*fl.KEY).distinct()
    packets = with_flow_key(on_time.unionByName(late)).join(keys, fl.KEY, "left_semi").select(*on_time.columns)
    again = fl.flows(packets, cfg).select(*flows.columns)
    return flows.join(keys, fl.KEY, "left_anti").select(*flows.columns).unionByName(again)

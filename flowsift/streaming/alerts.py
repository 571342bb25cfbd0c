"""Continuous detection over the flow stream (T2op, T4op, S5, S9, S10, T8op).

* T4op: rules are the same ``Column`` expressions as in batch (a stateless projection).
* T2op: the scan detector keeps, per source (and capture, as in batch), every flow within the
  window of what may still come (``applyInPandasWithState``). A flow is counted once the
  watermark has passed it, so late flows within the lateness count as in batch; an event-time
  timer counts what waits and clears a source once the watermark leaves its window.
* S5: alerts are appended per micro-batch to the same alert store as batch runs (one committed
  batch a micro-batch), so a replayed one rewrites its folder: exactly-once output with
  at-least-once runs.
* S9/T8op: a notification callback gets the payloads of alerts at or above a severity
  floor, per partition on the executors; a failing callback is caught and counted and
  never stops detection.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from flowsift.session import parquet_if_there
from flowsift.config import DEFAULT_CONFIG, DetectionConfig
from flowsift.operators import alerts as al
from flowsift.operators import findings as fd
from flowsift.operators import rules as ru
from flowsift.operators import scans as sc
from flowsift.schemas import FLOWS
from flowsift.sources.alertstore import append_alerts, read_alerts
from flowsift.sources.rulefiles import Rule
from flowsift.streaming.flows import check_late, event_time, run_available

COUNT_SCHEMA = ("capture_id string, src_ip string, flow_id string, dst_ip string, src_port int, dst_port int, "
                "protocol int, last_seen_us long, distinct_ports long, distinct_hosts long")
SCAN_COLUMNS = ["flow_id", "dst_ip", "src_port", "dst_port", "protocol", "last_seen_us"]
SCAN_INPUT = ("capture_id string, src_ip string, flow_id string, dst_ip string, src_port int, dst_port int, "
              "protocol int, last_seen_us long")
SCAN_STATE = ("done_us long, flow_id array<string>, dst_ip array<string>, src_port array<int>, dst_port array<int>, "
              "protocol array<int>, last_seen_us array<long>")

#: No window is complete yet; before any time, which may be before the epoch.
NONE_DONE = -(1 << 62)


def _distinct_in_window(t: np.ndarray, target: np.ndarray, at: np.ndarray, w: int) -> np.ndarray:
    """Distinct targets seen in [x - w, x] for each x of ``at``: a sighting covers the time until its
    target's next one, w at most, and covers of one target never overlap."""
    order = np.lexsort((t, target))
    t, target = t[order], target[order]
    end = t + w + 1
    again = target[1:] == target[:-1]
    end[:-1][again] = np.minimum(end[:-1], t[1:])[again]
    return np.searchsorted(np.sort(t), at, "right") - np.searchsorted(np.sort(end), at, "right")


def _scan_state(cfg: DetectionConfig):
    w = cfg.window_us
    cols = [c.split(" ")[0] for c in COUNT_SCHEMA.split(", ")]
    kinds = {"src_port": "int32", "dst_port": "int32", "protocol": "int32", "last_seen_us": "int64"}

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        done, parts = NONE_DONE, []
        if state.exists:
            done, *kept = state.get
            parts.append(pd.DataFrame(dict(zip(SCAN_COLUMNS, map(list, kept)))).astype(kinds))
        if not state.hasTimedOut:
            parts += [b[SCAN_COLUMNS] for b in batches]
        rows = pd.concat(parts, ignore_index=True)
        # no flow at or before the watermark can still come: windows that end there are complete
        now = max(done, state.getCurrentWatermarkMs() * 1000 or NONE_DONE)  # a watermark of 0 is none yet
        t = rows["last_seen_us"].to_numpy("int64")
        ready = (t > done) & (t <= now)
        out = rows[ready].copy()
        host = pd.factorize(rows["dst_ip"], use_na_sentinel=False)[0]
        port = rows.assign(h=host).groupby(["h", "dst_port"], dropna=False, sort=False).ngroup().to_numpy()
        out["distinct_ports"] = _distinct_in_window(t, port, t[ready], w)
        out["distinct_hosts"] = _distinct_in_window(t, host, t[ready], w)
        for i, c in enumerate(_stream_scope(cfg)):
            out[c] = key[i]
        if "capture_id" not in out:
            out["capture_id"] = None
        keep = rows[t > now - w - 1]
        if len(keep):
            state.update((now, *[keep[c].tolist() for c in SCAN_COLUMNS]))
            waiting = keep["last_seen_us"][keep["last_seen_us"] > now]
            due_us = int(waiting.min()) if len(waiting) else int(keep["last_seen_us"].max()) + w
            state.setTimeoutTimestamp(max(due_us // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        else:
            state.remove()
        yield out[cols]
    return step


def _stream_scope(cfg: DetectionConfig) -> list[str]:
    return ["src_ip"] if cfg.across_captures else ["capture_id", "src_ip"]


def stream_scan_findings(flows: DataFrame, cfg: DetectionConfig = DEFAULT_CONFIG,
                         watermark: str = "0 seconds") -> DataFrame:
    """T2op: scan findings over a streaming flow table (state keyed like the batch form). A flow's
    finding comes once the watermark has passed its ``last_seen``."""
    from flowsift.session import ship_package

    ship_package(flows.sparkSession)
    f = flows.withColumn("_ts", event_time("last_seen_us")).withWatermark("_ts", watermark)
    counts = (f.select("capture_id", "src_ip", *SCAN_COLUMNS, "_ts")
              .groupBy(*_stream_scope(cfg))
              .applyInPandasWithState(_scan_state(cfg), COUNT_SCHEMA, SCAN_STATE, "append",
                                      GroupStateTimeout.EventTimeTimeout))
    return sc.scan_findings(None, cfg, counts=counts)


def stream_rule_findings(flows: DataFrame, rules: list[Rule]) -> DataFrame:
    """T4op: the batch rule projection, unchanged, on a stream."""
    return ru.rule_findings(flows, rules)


def alert_sink(table: str, notify: Callable[[list[dict]], None] | None = None,
               min_severity: str = "low", name: str = "stream"):
    """S5 + S9 as a ``foreachBatch`` function: micro-batch n is the store's batch ``<name>-<n>``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        append_alerts(batch, table, f"{name}-{batch_id}")
        if notify is None:
            return
        payloads = al.notify_payloads(batch, min_severity)
        spark = batch.sparkSession
        failures = spark.sparkContext.accumulator(0)

        def deliver(rows):
            items = [json.loads(r.payload) for r in rows]
            if not items:
                return
            try:
                notify(items)
            except Exception:  # noqa: BLE001 - a failing notifier must not stop detection
                failures.add(1)

        payloads.foreachPartition(deliver)
    return write


def run_detection_to_end(spark: SparkSession, flows_dir: str, alerts_table: str, checkpoint: str,
                         rules: list[Rule], cfg: DetectionConfig = DEFAULT_CONFIG,
                         notify: Callable[[list[dict]], None] | None = None,
                         lateness_s: int | None = None, allow_late: bool = False,
                         max_files_per_trigger: int | None = None, progress: list[dict] | None = None) -> DataFrame:
    """Second query over the flow table written by the flow stream: rules + scan state ->
    alerts appended by ``foreachBatch``. Returns the alert table.

    ``lateness_s`` (idle and active limit and ten minutes, if not given) is how far a flow's
    ``last_seen`` may lie behind the newest one of earlier micro-batches; later flows raise
    ``LateRows`` unless ``allow_late``. The flushing flow is a second source of the scan state only; it leaves the
    checkpoint's watermark past the newest flow, so a later call with the same checkpoint takes newer flows only."""
    lateness_s = _lateness(cfg) if lateness_s is None else lateness_s
    flows, seen, end_dir = _flow_sources(spark, flows_dir, checkpoint, max_files_per_trigger)
    findings = fd.union_findings(stream_rule_findings(flows, rules),
                                 stream_scan_findings(seen, cfg, f"{int(lateness_s)} seconds"))
    alerts = fd.alerts_from_findings(findings)
    writer = (alerts.writeStream.foreachBatch(alert_sink(alerts_table, notify))
              .option("checkpointLocation", checkpoint))
    _run_and_flush(spark, writer, flows_dir, end_dir, cfg, lateness_s, allow_late, progress)
    return read_alerts(spark, alerts_table)


def run_scans_to_end(spark: SparkSession, flows_dir: str, out_dir: str, checkpoint: str,
                     cfg: DetectionConfig = DEFAULT_CONFIG, lateness_s: int | None = None, allow_late: bool = False,
                     max_files_per_trigger: int | None = None, progress: list[dict] | None = None) -> DataFrame:
    """T2op alone: the scan findings of a folder of flow files, every window counted. Parameters as
    :func:`run_detection_to_end`."""
    lateness_s = _lateness(cfg) if lateness_s is None else lateness_s
    _, seen, end_dir = _flow_sources(spark, flows_dir, checkpoint, max_files_per_trigger)
    found = stream_scan_findings(seen, cfg, f"{int(lateness_s)} seconds")
    writer = (found.writeStream.format("parquet").option("path", out_dir)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    _run_and_flush(spark, writer, flows_dir, end_dir, cfg, lateness_s, allow_late, progress)
    return spark.read.schema(found.schema).parquet(out_dir)


def _lateness(cfg: DetectionConfig) -> int:
    return (cfg.idle_us + cfg.active_us) // 1_000_000 + 600


def _flow_sources(spark: SparkSession, flows_dir: str, checkpoint: str,
                  max_files_per_trigger: int | None) -> tuple[DataFrame, DataFrame, str]:
    """(flow stream, scan input with the flushing flow's source, that source's folder)."""
    end_dir = checkpoint.rstrip("/") + "-end"
    spark.createDataFrame([], SCAN_INPUT).write.mode("append").parquet(end_dir)
    reader = spark.readStream.schema(FLOWS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    flows = reader.parquet(flows_dir)
    seen = flows.select("capture_id", "src_ip", *SCAN_COLUMNS).unionByName(
        spark.readStream.schema(SCAN_INPUT).parquet(end_dir))
    return flows, seen, end_dir


def _run_and_flush(spark: SparkSession, writer, flows_dir: str, end_dir: str, cfg: DetectionConfig, lateness_s: int,
                   allow_late: bool, progress: list[dict] | None) -> None:
    progress = [] if progress is None else progress
    run_available(spark, writer, progress)
    newest = spark.read.schema(FLOWS).parquet(flows_dir).agg(F.max("last_seen_us")).first()[0] or 0
    end_us = max(int(newest), 0) + cfg.window_us + (int(lateness_s) + 10) * 1_000_000
    spark.createDataFrame([("__end__", "0.0.0.0", "", "0.0.0.0", 0, 0, 0, end_us)], SCAN_INPUT).write.mode("append").parquet(end_dir)
    run_available(spark, writer, progress)  # moves the watermark past every flow
    run_available(spark, writer, progress)  # a batch in which the last windows are counted
    check_late(progress, allow_late)


def live_feed(alerts: DataFrame) -> DataFrame:
    """The live detection payload as JSON text, ready for a file/Kafka sink."""
    p = al.live_payloads(alerts)
    return p.select(F.to_json(F.struct(*[c for c in p.columns if c != "id"])).alias("value"))


def latest_buffer_sink(table: str, n: int = al.LIVE_BUFFER):
    """O2 on a stream: keep the newest ``n`` alerts as a snapshot table. Each micro-batch
    merges the previous snapshot (at most ``n`` rows) with the batch and keeps the top ``n``
    (``TakeOrderedAndProject``); the snapshot for batch k is written to its own folder and
    a replayed batch rewrites it, so the buffer is exactly-once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev = parquet_if_there(spark, f"{table}/snapshot={batch_id - 1}") if batch_id > 0 else None
        rows = batch if prev is None else prev.unionByName(batch)
        al.latest(rows, n).write.mode("overwrite").parquet(f"{table}/snapshot={batch_id}")
    return write

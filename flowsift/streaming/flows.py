"""Continuous flow tracking (T1op-T6op) with Structured Streaming.

``withWatermark(ts)`` + ``applyInPandasWithState`` keeps one open flow per key as exact integer
moments. A call costs milliseconds whatever it holds, so keys are dealt by their hash into ``SLOTS``
groups: calls grow with the slots, not with the keys. A call packs its packets into arrays as they come
and folds them by whole columns, so a flood key's micro-batch takes tens of bytes and no Python step for a packet. For every micro-batch the packets of a key are
handled in arrival order *before* its timer (a packet arriving exactly at the idle or active limit
opens a new flow, like the batch form); FIN/RST closes the flow with the packet. A flow's
timer is the earlier of ``last + idle`` and ``first + active`` (the slot's is the earliest of its flows); it fires
once the watermark passes it, so the stream emits the same flows as the batch sessionizer on input
whose packets come in the order of their numbers (``pkt_idx``) and whose times run back by no more
than the watermark delay (the lateness). Spark leaves out older rows and counts them in
``numRowsDroppedByWatermark``; ``run_to_end`` raises on them. ``flowsift.streaming.late`` holds back
what comes out of order and corrects its flows.

The flush at end of input (T3op) is a sentinel packet far in the future, in a second source
beside the checkpoint: it moves the watermark past every timer.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from flowsift.config import DEFAULT_CONFIG, FLAG_LETTERS, DetectionConfig
from flowsift.functions.flags import flag_count_columns, is_terminator
from flowsift.functions.keys import with_flow_key
from flowsift.operators.flows import KEY, finalize_flows
from flowsift.streaming.progress import OBSERVED

FLAGS = [n for _, n in FLAG_LETTERS]
MOMENTS = [f"{p}_{m}" for p in ("fl", "bl", "iat") for m in ("n", "s1", "s2", "min", "max")]
OUT_SCHEMA = (
    "capture_id string, lo_ip string, hi_ip string, lo_port int, hi_port int, protocol int, "
    "start_idx long, src_ip string, dst_ip string, src_port0 int, dst_port0 int, "
    "first_seen_us long, last_seen_us long, _last_term boolean, close_reason string, "
    + ", ".join(f"{m} string" for m in MOMENTS) + ", " + ", ".join(f"{f} long" for f in FLAGS)
)
STATE_SCHEMA = "flows string"
#: Set on one more row of each call only: by how many its slot holds more open flows than before.
OPENED = ", _opened long"
#: Keys are dealt into this many slots by their hash. It is part of a checkpoint's state and never changed for one.
SLOTS = 1024


#: A call gives its flows out in frames of so many rows.
FRAME = 10_000
#: Below these bounds, sums of two halves' products stay in 64 bits.
HALF, MOST_ROWS = 20, 1 << 23


def _packed(batches: Iterator[pd.DataFrame]) -> tuple[list[tuple], dict[str, np.ndarray]]:
    """(keys, columns): a call's packets by key, in arrival order. A batch is packed into numbers when it comes, so
    that some tens of bytes are held for a packet and a key's text once."""
    numbers: dict[tuple, int] = {}
    parts: dict[str, list[np.ndarray]] = {c: [] for c in ("key", "pkt_idx", "ts_us", "length", "sized", "is_fwd", "term", *FLAGS)}
    for b in batches:
        if not len(b):
            continue
        number = b.groupby(KEY, sort=False, dropna=False).ngroup().to_numpy()
        first = np.unique(number, return_index=True)[1]
        keys = [tuple(None if k != k else int(k) if isinstance(k, float) else k for k in key)
                for key in b[KEY].iloc[first].itertuples(index=False, name=None)]
        parts["key"].append(np.array([numbers.setdefault(k, len(numbers)) for k in keys], "int32")[number])
        for c in ("pkt_idx", "ts_us"):
            parts[c].append(b[c].astype("int64").to_numpy())  # raises on nulls
        parts["sized"].append(b["length"].notna().to_numpy("bool"))
        parts["length"].append(b["length"].fillna(0).astype("int64").to_numpy())
        for c in ("is_fwd", "term"):
            parts[c].append(b[c].eq(True).to_numpy("bool"))
        for c in FLAGS:
            parts[c].append(b[c].astype("int32").to_numpy())
    if not numbers:
        return [], {}
    order = np.lexsort((np.concatenate(parts["pkt_idx"]), np.concatenate(parts["key"])))
    return [*numbers], {c: np.concatenate(parts.pop(c))[order] for c in [*parts]}


def _sums(v: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums of v and of its squares over the rows from each start to the next one."""
    hi, lo = v >> HALF, v & ((1 << HALF) - 1)
    if len(v) < MOST_ROWS and -(1 << HALF) < hi.min() and hi.max() < 1 << HALF:
        over = lambda x: np.add.reduceat(x, at)
        s2 = (over(hi * hi).astype(object) << 2 * HALF) + (over(hi * lo).astype(object) << HALF + 1) + over(lo * lo)
        return over(v), s2
    v = v.astype(object)
    return np.add.reduceat(v, at), np.add.reduceat(v * v, at)


def _moments(v: np.ndarray, valid: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    big = np.iinfo("int64")
    return [np.add.reduceat(valid, at, dtype="int64"), *_sums(np.where(valid, v, 0), at),
            np.minimum.reduceat(np.where(valid, v, big.max), at), np.maximum.reduceat(np.where(valid, v, big.min), at)]


def _fold(flows: dict[tuple, dict], batches: Iterator[pd.DataFrame], idle: int, active: int, now: int) -> Iterator[tuple]:
    """Takes a call's packets into its open flows (``flows``); the rows of the flows that they close. Work is done on
    whole columns, Python's own is for each flow, not for each packet."""
    keys, p = _packed(batches)
    if not keys:
        return
    key, ts, term = p["key"], p["ts_us"], p["term"]
    n = len(key)
    opens = np.ones(n, "bool")
    opens[1:] = key[1:] != key[:-1]
    runs = np.flatnonzero(opens)  # each key's first packet
    opens[1:] |= term[:-1] | (ts[1:] - ts[:-1] >= idle)
    prev, since = np.zeros_like(ts), ts.copy()  # since: of a segment's first packet, its flow's first time
    prev[1:] = ts[:-1]
    goes_on = {}  # packets that continue a flow held from before
    for i, k in zip(runs.tolist(), key[runs].tolist()):
        fl = flows.get(keys[k])
        if fl is None:
            continue
        t = int(ts[i])
        if t - fl["last"] >= idle or t - fl["first"] >= active:
            yield _row(keys[k], flows.pop(keys[k]), "expired" if t - fl["last"] >= idle else "active_timeout")
        else:
            goes_on[i] = fl
            prev[i], since[i] = fl["prev_ts"], fl["first"]
    segments = np.flatnonzero(opens)
    until = np.append(segments[1:], n)
    for s in np.flatnonzero(np.maximum.reduceat(ts, segments) - since[segments] >= active).tolist():
        a, b = int(segments[s]), int(until[s])
        newest, first = np.maximum.accumulate(ts[a:b]), int(since[a])
        while (j := int(np.searchsorted(newest, first + active))) < b - a:  # greedy: each cut's limit counts from its own packet
            opens[a + j] = True
            first = int(ts[a + j])
    at = np.flatnonzero(opens)
    ends = np.append(at[1:], n) - 1
    has_prev = ~opens
    has_prev[[*goes_on]] = True
    has_prev &= prev != 0  # a previous timestamp of exactly 0 is skipped
    fwd, sized = p["is_fwd"], p["sized"]  # a packet without a length counts in neither direction, as in batch
    moments = [*_moments(p["length"], fwd & sized, at), *_moments(p["length"], ~fwd & sized, at),
               *_moments(np.maximum(0, ts - prev), has_prev, at)]
    moments += [np.add.reduceat(p[f], at, dtype="int64") for f in FLAGS]
    follows = np.append(key[at[1:]] == key[at[:-1]], False)  # another flow of the key comes after
    idled = np.append(ts[at[1:]] - ts[ends[:-1]] >= idle, False)
    for lo in range(0, len(at), FRAME):
        of = slice(lo, lo + FRAME)
        begin, end = at[of], ends[of]
        for i, k, start, forward, first, last, fin, more, gap, *m in zip(*(x.tolist() for x in (
                begin, key[begin], p["pkt_idx"][begin], fwd[begin], ts[begin], ts[end], term[end], follows[of], idled[of],
                *(x[of] for x in moments)))):
            new = [[x[0], x[1], x[2], x[3] if x[0] else None, x[4] if x[0] else None] for x in (m[:5], m[5:10], m[10:15])]
            fl = goes_on.get(i)
            if fl is None:
                fl = _new_flow(keys[k], start, first, forward)
            _add(fl, last, fin, new, m[15:])
            if fin or more:
                flows.pop(keys[k], None)
                yield _row(keys[k], fl, "fin_rst" if fin else "expired" if gap else "active_timeout")
            else:
                fl["due"] = max(int(math.ceil(min(fl["last"] + idle, fl["first"] + active) / 1000)), now + 1)
                flows[keys[k]] = fl


def _new_flow(key: tuple, start: int, first: int, fwd: bool) -> dict:
    lo_ip, hi_ip, lo_port, hi_port = key[1:5]
    return {"key": key, "start": start, "first": first, "last": first, "prev_ts": None,
            "open": [lo_ip, hi_ip, lo_port, hi_port] if fwd else [hi_ip, lo_ip, hi_port, lo_port], "term": False,
            "m": {p: [0, 0, 0, None, None] for p in ("fl", "bl", "iat")}, "flags": [0] * len(FLAGS)}


def _add(fl: dict, last: int, term: bool, moments: list[list], flags: list[int]) -> None:
    """Adds a piece of the flow: its last time, whether it ends the flow, its moments and flag counts."""
    fl["prev_ts"] = fl["last"] = last
    fl["term"] = term
    for m, x in zip(fl["m"].values(), moments):
        if x[0]:
            m[:3] = [a + b for a, b in zip(m[:3], x)]
            m[3] = x[3] if m[3] is None else min(m[3], x[3])
            m[4] = x[4] if m[4] is None else max(m[4], x[4])
    fl["flags"] = [a + b for a, b in zip(fl["flags"], flags)]


def _row(key: tuple, fl: dict, reason: str) -> tuple:
    mom = []
    for p in ("fl", "bl", "iat"):
        n, s1, s2, mn, mx = fl["m"][p]
        mom += [str(n), str(s1) if n else None, str(s2) if n else None,
                None if mn is None else str(mn), None if mx is None else str(mx)]
    return (*key, fl["start"], *fl["open"], fl["first"], fl["last"], fl["term"], reason, *mom, *fl["flags"])


def _tracker(cfg: DetectionConfig):
    idle, active = cfg.idle_us, cfg.active_us
    cols, kinds = zip(*[c.split(" ") for c in (OUT_SCHEMA + OPENED).split(", ")])
    blank = [None if k == "string" else k != "boolean" and 0 for k in kinds[:-1]]  # whole numbers stay whole

    def closed(flows: dict[tuple, dict], batches: Iterator[pd.DataFrame], state: GroupState, now: int) -> Iterator[tuple]:
        if not state.hasTimedOut:
            yield from _fold(flows, batches, idle, active, now)
        # timers of the keys without packets in this micro-batch
        for key in [k for k, fl in flows.items() if fl["due"] < now]:
            fl = flows.pop(key)
            reason = "active_timeout" if fl["first"] + active < fl["last"] + idle else "expired"
            yield _row(key, fl, reason)

    def step(slot: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        flows = {tuple(fl["key"]): fl for fl in (json.loads(state.get[0]) if state.exists else [])}
        held, now, out = len(flows), state.getCurrentWatermarkMs(), []
        for row in closed(flows, batches, state, now):
            out.append((*row, None))
            if len(out) == FRAME:
                yield pd.DataFrame(out, columns=cols)
                out = []
        if flows:
            state.update((json.dumps(list(flows.values()), separators=(",", ":")),))
            state.setTimeoutTimestamp(max(min(fl["due"] for fl in flows.values()), now + 1))
        elif state.exists:
            state.remove()
        out.append((*blank, len(flows) - held))
        yield pd.DataFrame(out, columns=cols)
    return step


def stream_flows(packets: DataFrame, cfg: DetectionConfig = DEFAULT_CONFIG,
                 watermark: str = "0 seconds") -> DataFrame:
    """T1op: a streaming packets DataFrame (PACKETS schema) -> a streaming flows DataFrame."""
    from flowsift.session import ship_package

    ship_package(packets.sparkSession)
    p = with_flow_key(packets)
    p = p.select(
        *KEY, "pkt_idx", "ts_us", "is_fwd", "length",
        is_terminator(F.col("tcp_flags")).alias("term"), *flag_count_columns(F.col("tcp_flags")),
        event_time("ts_us").alias("ts"))
    raw = (p.withWatermark("ts", watermark)
           .withColumn("slot", F.pmod(F.xxhash64(*KEY), F.lit(SLOTS)))
           .groupBy("slot")
           .applyInPandasWithState(_tracker(cfg), OUT_SCHEMA + OPENED, STATE_SCHEMA, "append",
                                   GroupStateTimeout.EventTimeTimeout))
    raw = raw.observe(OBSERVED, F.coalesce(F.sum("_opened"), F.lit(0)).alias("opened"))
    typed = raw.where(F.col("_opened").isNull()).select(
        *KEY, "start_idx", F.struct("src_ip", "dst_ip", "src_port0", "dst_port0").alias("_open"),
        "first_seen_us", "last_seen_us", "_last_term", "close_reason",
        *[F.col(m).cast("decimal(38,0)" if m.endswith(("s1", "s2")) else "long").alias(m) for m in MOMENTS],
        *FLAGS)
    return finalize_flows(typed, close_reason=F.col("close_reason"))


def event_time(us: str) -> Column:
    """The time that the watermark goes by. A watermark starts at the epoch and Spark leaves out what is not after it,
    so the epoch and earlier times count as the first millisecond; the flows keep the packets' own times."""
    return F.timestamp_micros(F.when(F.col(us) < 1_000, 1_000).otherwise(F.col(us)))


def sentinel_packet(spark: SparkSession, after_us: int, capture_id: str = "__end__") -> DataFrame:
    """T3op: one packet far past every timer; its own key is never emitted."""
    from flowsift.schemas import PACKETS

    return spark.createDataFrame(
        [(capture_id, 0, after_us, "0.0.0.0", "0.0.0.0", 0, None, None, 0, None, None, 0)], PACKETS)


class LateRows(RuntimeError):
    """Rows came later than the lateness allows and were left out of the result."""


def run_available(spark: SparkSession, writer: DataStreamWriter, progress: list[dict]) -> None:
    """One ``availableNow`` run of a stream writer; the progress reports of all its micro-batches are
    added to ``progress``."""
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, 1_000_000)
    try:
        q = writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(kept, before)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    progress.extend(dict(p) for p in q.recentProgress)


def check_late(progress: list[dict], allow_late: bool) -> None:
    from flowsift.streaming.progress import counters

    late = counters(progress)["dropped_late"]
    if late and not allow_late:
        raise LateRows(f"{late} rows were later than the stream's lateness; give a larger lateness_s")


def run_to_end(spark: SparkSession, packets_dir: str, out_dir: str, checkpoint: str,
               cfg: DetectionConfig = DEFAULT_CONFIG, end_us: int | None = None,
               max_files_per_trigger: int | None = None, lateness_s: int = 600, allow_late: bool = False,
               progress: list[dict] | None = None) -> DataFrame:
    """Drive the flow stream over a folder of packet files to completion (availableNow), flush
    every open flow, and return the flows written.

    ``lateness_s`` is how far a packet's time may lie behind the newest one of earlier micro-batches;
    later packets raise :class:`LateRows` unless ``allow_late``. The flushing sentinel is a second
    source beside the checkpoint: the input folder is only read. It leaves the checkpoint's watermark past the
    newest packet by both limits, so a later call with the same checkpoint takes newer packets only. Progress
    reports are added to ``progress`` (G11 counters: ``flowsift.streaming.progress.counters``). Where packets can be
    late, ``flowsift.streaming.late`` keeps them in a side table and corrects their flows."""
    from flowsift.schemas import PACKETS
    from flowsift.sources.packets import stream_packets

    end_dir = checkpoint.rstrip("/") + "-end"
    spark.createDataFrame([], PACKETS).write.mode("append").parquet(end_dir)
    src = stream_packets(spark, packets_dir, max_files_per_trigger=max_files_per_trigger)
    src = src.unionByName(stream_packets(spark, end_dir))
    flows = stream_flows(src, cfg, f"{int(lateness_s)} seconds")
    writer = (flows.writeStream.format("parquet").option("path", out_dir)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    progress = [] if progress is None else progress
    run_available(spark, writer, progress)
    if end_us is None:
        end_us = spark.read.schema(PACKETS).parquet(packets_dir).agg(F.max("ts_us")).first()[0] or 0
    end_us = max(int(end_us), 0) + cfg.active_us + cfg.idle_us + (int(lateness_s) + 10) * 1_000_000
    sentinel_packet(spark, end_us).write.mode("append").parquet(end_dir)
    run_available(spark, writer, progress)  # moves the watermark past every timer
    run_available(spark, writer, progress)  # a batch in which the timers fire
    check_late(progress, allow_late)
    return spark.read.parquet(out_dir).where(F.col("capture_id") != "__end__")

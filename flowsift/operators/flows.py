"""Flow sessionization (G1-G11): packets -> bidirectional flows with 26 features.

Semantics, per canonical 5-tuple key within a capture, packets in arrival order
(``pkt_idx``):

* G1  a packet carrying FIN or RST closes its flow, itself included;
* G2  a packet arriving ``>= idle`` after the previous packet of the key opens a new flow;
* G3  a packet arriving ``>= active`` after the *first* packet of the current flow opens a
      new flow (greedy, so it depends on where the previous cut fell);
* G4  end of input closes everything.

Plan shape (batch):

1. one hash exchange on ``(key, bucket)`` where ``bucket = pkt_idx div B``; ``lag`` and a
   running max inside the bucket, with bucket edges stitched from a per-bucket summary.
   A flood key is spread over ``#packets / B`` tasks instead of one.
2. ``groupBy(key, segment)`` with partial aggregation: map-side combine leaves one
   partial row per (segment, bucket) before the second exchange. Moments are exact
   integers (DECIMAL(38,0)), so results do not depend on summation order.
3. G3 only touches segments whose span reaches ``active``; their cuts come from sparse
   pointer doubling (``flowsift.operators.activecut``): about log2(cells) rounds of
   equi-joins over tables that halve from round to round, nothing per segment in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from flowsift.config import DEFAULT_CONFIG, FEATURES, FLAG_LETTERS, MIN_DURATION_S, US, DetectionConfig
from flowsift.functions.flags import flag_count_columns, is_terminator
from flowsift.functions.keys import port0, with_flow_key
from flowsift.operators.activecut import active_cuts
from flowsift.operators.stitch import latest_marker
from flowsift.schemas import FLOW_KEY, FLOWS
from flowsift.session import ensure_checkpoint_dir, materialize

KEY = list(FLOW_KEY)
FLAG_FEATURES = [name for _, name in FLAG_LETTERS]
FLOW_COLUMNS = [f.name for f in FLOWS.fields]
DEC = "decimal(38,0)"
CUTS = ("capture_id string, lo_ip string, hi_ip string, lo_port int, hi_port int, protocol int, "
        "seg_idx long, cut_idx long, cut_ts long")


# ---------------------------------------------------------------------------
# stage 1: segments (G1 + G2), skew-safe
# ---------------------------------------------------------------------------

def keyed_packets(packets: DataFrame, cfg: DetectionConfig = DEFAULT_CONFIG) -> DataFrame:
    """P1/P2/P6/P7 per packet: canonical key, direction, flag counts, terminator.

    Key and bucket columns are made provably non-null (packets always carry them), so the
    join on (key, bucket) infers no ``isnotnull`` filter that would differ between the two
    branches of the stitch - the packet exchange is then computed once and reused."""
    p = with_flow_key(packets)
    nn = {"capture_id": F.lit(""), "lo_ip": F.lit(""), "hi_ip": F.lit(""), "lo_port": F.lit(0),
          "hi_port": F.lit(0), "protocol": F.lit(0)}
    return p.select(
        *[F.coalesce(F.col(k), nn[k]).alias(k) for k in KEY], "pkt_idx", "ts_us", "is_fwd", "length",
        "src_ip", "dst_ip", port0("src_port").alias("src_port0"), port0("dst_port").alias("dst_port0"),
        is_terminator(F.col("tcp_flags")).alias("term"),
        *flag_count_columns(F.col("tcp_flags")),
        F.coalesce(F.expr(f"pkt_idx div {int(cfg.packet_bucket)}"), F.lit(0)).cast("long").alias("bkt"),
    )


def segment_packets(packets: DataFrame, cfg: DetectionConfig = DEFAULT_CONFIG,
                    cache: list | None = None) -> DataFrame:
    """Per packet: ``seg`` = struct(pkt_idx, ts_us) of the packet that opened its G1/G2
    segment, ``is_start``, and ``iat_us`` (gap to the previous packet of the same segment;
    null on a segment's first packet and when the previous timestamp is exactly 0)."""
    idle = cfg.idle_us
    p = keyed_packets(packets, cfg)
    wl = Window.partitionBy(*KEY, "bkt").orderBy("pkt_idx")
    p = p.withColumn("_prev", F.lag(F.struct("ts_us", "term")).over(wl))
    start_local = F.col("_prev").isNotNull() & (
        F.col("_prev.term") | ((F.col("ts_us") - F.col("_prev.ts_us")) >= idle))
    marker = F.when(start_local, F.struct("pkt_idx", "ts_us"))
    p = (p.withColumn("_start_local", start_local)
         .withColumn("_run", F.max(marker).over(
             wl.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    if cache is not None:
        # both the bucket summary and the join read this frame: keep the scan, the exchange
        # and the window from running twice (lost blocks are recomputed from lineage)
        p = p.persist(StorageLevel.MEMORY_AND_DISK)
        cache.append(p)

    # per-bucket summary: first and last packet, latest interior segment start
    summ = p.groupBy(*KEY, "bkt").agg(
        F.min_by(F.struct("pkt_idx", "ts_us"), "pkt_idx").alias("_bfirst"),
        F.max_by(F.struct("ts_us", "term"), "pkt_idx").alias("_blast"),
        F.max(F.when(F.col("_start_local"), F.struct("pkt_idx", "ts_us"))).alias("_binner"),
    )
    wb = Window.partitionBy(*KEY).orderBy("bkt")
    summ = summ.withColumn("_carry", F.lag("_blast").over(wb))
    first_is_start = (F.col("_carry").isNull() | F.col("_carry.term")
                      | ((F.col("_bfirst.ts_us") - F.col("_carry.ts_us")) >= idle))
    summ = summ.withColumn("_bfirst_start", first_is_start)
    bucket_latest = F.greatest(F.col("_binner"), F.when(F.col("_bfirst_start"), F.col("_bfirst")))
    summ = summ.select(
        *KEY, "bkt", "_bfirst", "_bfirst_start",
        F.col("_carry.ts_us").alias("_carry_ts"),
        F.max(bucket_latest).over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry_seg"),
    )

    p = p.join(summ, [*KEY, "bkt"], "left")
    is_first = F.col("_prev").isNull()
    is_start = F.when(is_first, F.col("_bfirst_start")).otherwise(F.col("_start_local"))
    prev_ts = F.when(is_first, F.col("_carry_ts")).otherwise(F.col("_prev.ts_us"))
    seg = F.coalesce(F.col("_run"), F.when(F.col("_bfirst_start"), F.col("_bfirst")), F.col("_carry_seg"))
    iat = F.when(~is_start & prev_ts.isNotNull() & (prev_ts != 0),
                 F.greatest(F.lit(0), F.col("ts_us") - prev_ts))
    return p.select(
        *KEY, "pkt_idx", "ts_us", "is_fwd", "length", "src_ip", "dst_ip", "src_port0", "dst_port0",
        "term", *FLAG_FEATURES, "bkt",
        is_start.alias("is_start"), seg.alias("seg"), iat.cast("long").alias("iat_us"),
    )


# ---------------------------------------------------------------------------
# aggregation (G5-G10) and the feature projection
# ---------------------------------------------------------------------------

def _moments(prefix: str, value: Column, when: Column | None = None) -> list[Column]:
    v = value if when is None else F.when(when, value)
    return [
        F.count(v).alias(f"{prefix}_n"),
        F.sum(v.cast(DEC)).alias(f"{prefix}_s1"),
        F.sum(v.cast(DEC) * v.cast(DEC)).alias(f"{prefix}_s2"),
        F.min(v).alias(f"{prefix}_min"),
        F.max(v).alias(f"{prefix}_max"),
    ]


def flow_aggregates() -> list[Column]:
    """Partial-aggregatable flow state: counts, exact integer moments, first/last packet."""
    fwd = F.col("is_fwd")
    return [
        F.min_by(F.struct("src_ip", "dst_ip", "src_port0", "dst_port0"), "pkt_idx").alias("_open"),
        F.min_by("ts_us", "pkt_idx").alias("first_seen_us"),
        F.max_by("ts_us", "pkt_idx").alias("last_seen_us"),
        F.max_by("term", "pkt_idx").alias("_last_term"),
        *_moments("fl", F.col("length"), fwd),
        *_moments("bl", F.col("length"), ~fwd),
        *_moments("iat", F.col("iat_us")),
        *[F.sum(c).alias(c) for c in FLAG_FEATURES],
    ]


def _mean(prefix: str, scale: float = 1.0) -> Column:
    n = F.col(f"{prefix}_n")
    m = F.col(f"{prefix}_s1").cast("double") / n
    if scale != 1.0:
        m = m / F.lit(scale)
    return F.when(n > 0, m).otherwise(F.lit(0.0))


def _std(prefix: str, scale: float = 1.0) -> Column:
    """Population std from exact integer moments: sqrt(n*S2 - S1^2) / n; 0 when n < 2."""
    n, s1, s2 = F.col(f"{prefix}_n"), F.col(f"{prefix}_s1"), F.col(f"{prefix}_s2")
    var_num = (n.cast(DEC) * s2 - s1 * s1).cast("double")
    s = F.sqrt(var_num) / n
    if scale != 1.0:
        s = s / F.lit(scale)
    return F.when(n >= 2, s).otherwise(F.lit(0.0))


def finalize_flows(agg: DataFrame, start_col: str = "start_idx",
                   close_reason: Column | None = None) -> DataFrame:
    """Aggregated flow state -> the flows schema (identity, times, 26 features)."""
    fwd_p, bwd_p = F.col("fl_n"), F.col("bl_n")
    fwd_b, bwd_b = F.coalesce(F.col("fl_s1").cast("long"), F.lit(0)), F.coalesce(F.col("bl_s1").cast("long"), F.lit(0))
    duration = F.greatest(F.lit(MIN_DURATION_S),
                          (F.col("last_seen_us") - F.col("first_seen_us")).cast("double") / F.lit(float(US)))
    total_p = fwd_p + bwd_p
    total_b = fwd_b + bwd_b
    if close_reason is None:
        close_reason = F.when(F.col("_last_term"), F.lit("fin_rst")).otherwise(F.lit("expired"))
    feats = {
        "duration_s": duration,
        "total_packets": total_p,
        "total_bytes": total_b,
        "fwd_packets": fwd_p,
        "bwd_packets": bwd_p,
        "fwd_bytes": fwd_b,
        "bwd_bytes": bwd_b,
        "fwd_pkt_len_mean": _mean("fl"),
        "fwd_pkt_len_std": _std("fl"),
        "fwd_pkt_len_min": F.coalesce(F.col("fl_min").cast("double"), F.lit(0.0)),
        "fwd_pkt_len_max": F.coalesce(F.col("fl_max").cast("double"), F.lit(0.0)),
        "bwd_pkt_len_mean": _mean("bl"),
        "bwd_pkt_len_std": _std("bl"),
        "bwd_pkt_len_min": F.coalesce(F.col("bl_min").cast("double"), F.lit(0.0)),
        "bwd_pkt_len_max": F.coalesce(F.col("bl_max").cast("double"), F.lit(0.0)),
        "iat_mean": _mean("iat", float(US)),
        "iat_std": _std("iat", float(US)),
        "bytes_per_s": total_b.cast("double") / duration,
        "packets_per_s": total_p.cast("double") / duration,
        "down_up_ratio": F.when(fwd_p > 0, bwd_p.cast("double") / fwd_p.cast("double")).otherwise(F.lit(0.0)),
        **{c: F.col(c) for c in FLAG_FEATURES},
    }
    flow_id = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in KEY],
                                F.col(start_col).cast("string")))
    return agg.select(
        flow_id.alias("flow_id"),
        *KEY,
        F.col("_open.src_ip").alias("src_ip"), F.col("_open.dst_ip").alias("dst_ip"),
        F.col("_open.src_port0").alias("src_port"), F.col("_open.dst_port0").alias("dst_port"),
        F.col(start_col).alias("first_pkt_idx"),
        "first_seen_us", "last_seen_us",
        close_reason.alias("close_reason"),
        *[feats[f].alias(f) for f in FEATURES],
    )


# ---------------------------------------------------------------------------
# public entry points
# ---------------------------------------------------------------------------

def flows_no_active(packets: DataFrame, cfg: DetectionConfig = DEFAULT_CONFIG) -> DataFrame:
    """G1 + G2 only (every segment is one flow): fully lazy, one plan."""
    seg = segment_packets(packets, cfg).withColumn("start_idx", F.col("seg.pkt_idx"))
    agg = seg.groupBy(*KEY, "start_idx").agg(*flow_aggregates())
    return finalize_flows(agg)


def sessionize(packets: DataFrame, cfg: DetectionConfig = DEFAULT_CONFIG) -> tuple[DataFrame, DataFrame]:
    """G1-G4 complete -> (flows, active cuts). Segments that never reach ``active`` are final
    after one aggregation; the rest (found by a count over segment rows) go through the
    G3 doubling. The per-packet segment table is persisted (recomputable from lineage if an
    executor is lost) and the small segment aggregate is written to the shared checkpoint folder."""
    ensure_checkpoint_dir(packets.sparkSession)
    a = cfg.active_us
    cached: list = []
    # only the windowed packet frame is cached (one packet-sized copy); the segment columns are
    # re-derived from it and the small bucket summary when the long segments are read again
    seg = segment_packets(packets, cfg, cached)
    seg_agg = materialize(
        seg.withColumn("start_idx", F.col("seg.pkt_idx"))
        .groupBy(*KEY, "start_idx")
        .agg(*flow_aggregates(), F.max(F.col("ts_us") - F.col("seg.ts_us")).alias("_span")),
        "flow-segments")
    long_segs = seg_agg.where(F.col("_span") >= a).select(
        *KEY, F.col("start_idx").alias("seg_idx"), F.col("_span").alias("span"))
    short = finalize_flows(seg_agg.where(F.col("_span") < a))
    top = long_segs.agg(F.max("span")).first()[0]
    if top is None:  # no long segment
        out = materialize(short, "flows")
        for c in cached:
            c.unpersist()
        return out, packets.sparkSession.createDataFrame([], CUTS)

    lp = (seg.withColumn("seg_idx", F.col("seg.pkt_idx"))
          .join(long_segs.select(*KEY, "seg_idx"), [*KEY, "seg_idx"], "left_semi"))
    rel = F.col("ts_us") - F.col("seg.ts_us")
    elig = materialize(lp.where((rel >= a) | (F.col("pkt_idx") == F.col("seg_idx")))
                       .select(*KEY, "seg_idx", "pkt_idx", "ts_us", rel.alias("rel_us")), "flow-long-packets")
    found, _ = active_cuts(elig.select("capture_id", "seg_idx", "pkt_idx", "rel_us"), top // a + 1, a)
    found = materialize(found, "flow-cuts")
    cuts = elig.join(found.withColumnRenamed("cut_idx", "pkt_idx"), ["capture_id", "seg_idx", "pkt_idx"]).select(
        *KEY, "seg_idx", F.col("pkt_idx").alias("cut_idx"), F.col("ts_us").alias("cut_ts"))

    # assign every packet of a long segment to the latest cut at or before it
    marks = cuts.select(*KEY, F.col("cut_idx").alias("pkt_idx"), F.lit(True).alias("is_cut"))
    lp = lp.join(marks, [*KEY, "pkt_idx"], "left").withColumn(
        "is_cut", F.coalesce(F.col("is_cut"), F.lit(False)))
    marker = F.when(F.col("is_cut") | (F.col("pkt_idx") == F.col("seg_idx")), F.col("pkt_idx"))
    lp = latest_marker(lp, [*KEY, "seg_idx"], "bkt", "pkt_idx", marker, "start_idx")
    lp = lp.withColumn("iat_us", F.when(F.col("is_cut"), F.lit(None)).otherwise(F.col("iat_us")))
    last_cut = cuts.groupBy(*KEY, "seg_idx").agg(F.max("cut_idx").alias("_last_cut"))
    agg = (lp.groupBy(*KEY, "seg_idx", "start_idx").agg(*flow_aggregates())
           .join(last_cut, [*KEY, "seg_idx"], "left"))
    reason = (F.when(F.col("_last_term"), F.lit("fin_rst"))
              .when(F.col("start_idx") < F.coalesce(F.col("_last_cut"), F.lit(-1)), F.lit("active_timeout"))
              .otherwise(F.lit("expired")))
    out = materialize(short.unionByName(finalize_flows(agg, close_reason=reason)), "flows")
    for c in cached:
        c.unpersist()
    return out, cuts


def flows(packets: DataFrame, cfg: DetectionConfig = DEFAULT_CONFIG) -> DataFrame:
    """The flow table, materialized once in the shared checkpoint folder (rules, the
    scan detector and the model all read it; one row per flow, far fewer than packets)."""
    return sessionize(packets, cfg)[0]


def engine_counters(packets: DataFrame, flows_df: DataFrame) -> DataFrame:
    """Packets seen and flows evaluated (batch: everything is flushed, 0 active)."""
    one = F.lit(1).alias("_one")
    return (packets.agg(F.count(F.lit(1)).alias("packets_seen")).select("*", one)
            .join(flows_df.agg(F.count(F.lit(1)).alias("flows_evaluated")).select("*", one), "_one")
            .select("packets_seen", "flows_evaluated", F.lit(0).cast("long").alias("active_flows")))

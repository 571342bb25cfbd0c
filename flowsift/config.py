"""Detection parameters and the fixed vocabularies every operator shares."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values (must equal the detector being re-implemented) -------------
# Ordered flow feature vector (26 names). Training and scoring both use it.
FEATURES: tuple[str, ...] = (
    "duration_s", "total_packets", "total_bytes", "fwd_packets", "bwd_packets",
    "fwd_bytes", "bwd_bytes",
    "fwd_pkt_len_mean", "fwd_pkt_len_std", "fwd_pkt_len_min", "fwd_pkt_len_max",
    "bwd_pkt_len_mean", "bwd_pkt_len_std", "bwd_pkt_len_min", "bwd_pkt_len_max",
    "iat_mean", "iat_std", "bytes_per_s", "packets_per_s", "down_up_ratio",
    "syn_count", "ack_count", "fin_count", "rst_count", "psh_count", "urg_count",
)
# Fields a threshold rule may reference besides the 26 features.
RULE_IDENTITY_FIELDS: tuple[str, ...] = ("protocol", "dst_port", "src_port")
# TCP flag letters counted per flow, with the feature each one feeds.
FLAG_LETTERS: tuple[tuple[str, str], ...] = (
    ("S", "syn_count"), ("A", "ack_count"), ("F", "fin_count"),
    ("R", "rst_count"), ("P", "psh_count"), ("U", "urg_count"),
)
# Severity names in rank order (low=0 ... critical=3).
SEVERITIES: tuple[str, ...] = ("low", "medium", "high", "critical")
# Detector kinds.
DETECTOR_SIGNATURE = "signature"
DETECTOR_ANOMALY = "anomaly"
# Protocol numbers.
PROTO_ICMP, PROTO_TCP, PROTO_UDP, PROTO_OTHER = 1, 6, 17, 0
# Scan detector finding identities.
PORT_SCAN_ID, PORT_SCAN_NAME = "HOST_PORT_SCAN", "Port scan detected"
HOST_SWEEP_ID, HOST_SWEEP_NAME = "HOST_SWEEP", "Host sweep detected"
# Anomaly finding identity.
ANOMALY_ID, ANOMALY_NAME = "ML_ANOMALY", "Anomalous flow (ML)"
# Default rule confidence when a rule file omits it.
DEFAULT_RULE_CONFIDENCE = 0.85
# Smallest flow duration in seconds (single-packet flows).
MIN_DURATION_S = 1e-6
# Labelled-flow CSV header -> feature name (24 features + Label).
CSV_COLUMN_MAP: tuple[tuple[str, str], ...] = (
    ("Flow Duration", "duration_s"),
    ("Total Fwd Packets", "fwd_packets"),
    ("Total Backward Packets", "bwd_packets"),
    ("Total Length of Fwd Packets", "fwd_bytes"),
    ("Total Length of Bwd Packets", "bwd_bytes"),
    ("Fwd Packet Length Mean", "fwd_pkt_len_mean"),
    ("Fwd Packet Length Std", "fwd_pkt_len_std"),
    ("Fwd Packet Length Min", "fwd_pkt_len_min"),
    ("Fwd Packet Length Max", "fwd_pkt_len_max"),
    ("Bwd Packet Length Mean", "bwd_pkt_len_mean"),
    ("Bwd Packet Length Std", "bwd_pkt_len_std"),
    ("Bwd Packet Length Min", "bwd_pkt_len_min"),
    ("Bwd Packet Length Max", "bwd_pkt_len_max"),
    ("Flow IAT Mean", "iat_mean"),
    ("Flow IAT Std", "iat_std"),
    ("Flow Bytes/s", "bytes_per_s"),
    ("Flow Packets/s", "packets_per_s"),
    ("Down/Up Ratio", "down_up_ratio"),
    ("SYN Flag Count", "syn_count"),
    ("ACK Flag Count", "ack_count"),
    ("FIN Flag Count", "fin_count"),
    ("RST Flag Count", "rst_count"),
    ("PSH Flag Count", "psh_count"),
    ("URG Flag Count", "urg_count"),
    ("Label", "label"),
)
BENIGN_LABEL = "BENIGN"
# -----------------------------------------------------------------------------

US = 1_000_000  # microseconds per second


@dataclass(frozen=True)
class DetectionConfig:
    """Knobs of the detection dataflow (defaults are the reference defaults)."""

    idle_timeout_s: float = 15.0
    active_timeout_s: float = 120.0
    scan_window_s: float = 30.0
    port_scan_threshold: int = 20
    host_sweep_threshold: int = 15
    anomaly_threshold: float = 0.5
    # Skew handling: packets of one flow key are windowed in buckets of this many
    # consecutive packet ordinals, and stitched across bucket edges, so a single
    # flood key never lands in one task.
    packet_bucket: int = 1 << 20
    # Flows of one source are dealt into time buckets for the sliding distinct count, at
    # least as wide as the scan window (this width in µs, if that is more).
    scan_time_bucket_us: int = 0
    # Scan state and open flows are kept per capture (CLI behaviour) unless set.
    across_captures: bool = False

    @property
    def idle_us(self) -> int:
        return int(round(self.idle_timeout_s * US))

    @property
    def active_us(self) -> int:
        return int(round(self.active_timeout_s * US))

    @property
    def window_us(self) -> int:
        return int(round(self.scan_window_s * US))


DEFAULT_CONFIG = DetectionConfig()

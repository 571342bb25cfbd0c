"""Finding union (U2) and the finding -> alert mapping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.operators.rules import FINDING_COLUMNS


def union_findings(*parts: DataFrame) -> DataFrame:
    """Rule findings ++ scan finding ++ anomaly finding; ``finding_order`` keeps the
    per-flow order (rules in load order, then the scan detector, then the model)."""
    return reduce(lambda a, b: a.unionByName(b), [p.select(*FINDING_COLUMNS) for p in parts])


def alerts_from_findings(findings: DataFrame) -> DataFrame:
    """One alert per finding. Deterministic id md5(flow_id|rule_id) so re-runs are
    idempotent; ``created_at`` is the flow's last packet time (UTC wall clock); an empty
    evidence becomes ``{}``. A pure projection: findings already carry flow identity."""
    return findings.select(
        F.md5(F.concat_ws("|", "flow_id", "rule_id")).alias("id"),
        # NTZ arithmetic: the wall clock in UTC whatever the session time zone
        F.expr("timestampadd(MICROSECOND, last_seen_us, TIMESTAMP_NTZ'1970-01-01 00:00:00')").alias("created_at"),
        "detector", "rule_id", "name", "severity", "confidence", "description",
        "src_ip", "dst_ip", "src_port", "dst_port", "protocol",
        F.coalesce(F.col("evidence"), F.lit("{}")).alias("evidence"),
        F.lit(False).alias("acknowledged"),
    )

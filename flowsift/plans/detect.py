"""The detection dataflow: packets -> flows -> findings -> alerts.

Shuffles: one exchange on the flow key (sessionizer), one on the source (scan window);
rules, the anomaly score and the alert mapping are narrow projections.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from flowsift.config import DEFAULT_CONFIG, DetectionConfig
from flowsift.operators import findings as fd
from flowsift.operators import flows as fl
from flowsift.operators import rules as ru
from flowsift.operators import scans as sc
from flowsift.sources.rulefiles import Rule, load_rules


@dataclass
class Detection:
    flows: DataFrame
    rule_findings: DataFrame
    scan_findings: DataFrame
    anomaly_findings: DataFrame | None
    findings: DataFrame
    alerts: DataFrame


def detect(packets: DataFrame, rules: list[Rule] | None = None,
           cfg: DetectionConfig = DEFAULT_CONFIG, model=None, flows: DataFrame | None = None) -> Detection:
    rules = load_rules() if rules is None else rules
    f = fl.flows(packets, cfg) if flows is None else flows
    rf = ru.rule_findings(f, rules)
    sf = sc.scan_findings(f, cfg)
    parts = [rf, sf]
    af = None
    if model is not None:
        from flowsift.operators import iforest

        af = iforest.anomaly_findings(f, model, cfg.anomaly_threshold)
        parts.append(af)
    allf = fd.union_findings(*parts)
    return Detection(f, rf, sf, af, allf, fd.alerts_from_findings(allf))

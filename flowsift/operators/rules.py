"""Threshold rules as data.

Two evaluators with identical results:

* ``rule_findings`` compiles every rule into one boolean ``Column`` and evaluates all
  of them in a single projection over the flows (one pass, whole-stage codegen, shared
  sub-expressions, short-circuit ``AND``); matches become an array of structs that is
  exploded - no join, no shuffle.
* ``rule_findings_longform`` keeps rules as data: an array of rules with their conditions is
  filtered by ``forall`` conditions on the flow's values (relational division), one generic
  projection whatever the rules say.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.config import DETECTOR_SIGNATURE, FEATURES, RULE_IDENTITY_FIELDS
from flowsift.sources.rulefiles import (
    Condition, Rule, numeric_members, rules_table, value_kind,
)

RULE_FIELDS: tuple[str, ...] = (*FEATURES, *RULE_IDENTITY_FIELDS)
OPS = ("eq", "ne", "gt", "gte", "lt", "lte", "in")

IDENTITY = ("flow_id", "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "last_seen_us")
FINDING_COLUMNS = (*IDENTITY, "finding_order", "detector", "rule_id", "name", "severity",
                   "confidence", "description", "evidence")


def compile_condition(c: Condition) -> Column:
    """One condition -> Column. Missing field: false (checked before the operator).
    Unknown operator on a known field: ValueError. Type mismatch: false, except that
    ``eq`` across types is false and ``ne`` across types is true."""
    if c.field not in RULE_FIELDS:
        return F.lit(False)
    if c.op not in OPS:
        raise ValueError(f"unknown rule operator: {c.op!r}")
    col = F.col(c.field)
    kind = value_kind(c.value)
    if c.op == "in":
        if kind != "list":
            return F.lit(False)
        members = numeric_members(c.value)
        return col.cast("double").isin(members) if members else F.lit(False)
    if kind != "num":
        return F.lit(c.op == "ne")
    v = F.lit(float(c.value))
    x = col.cast("double")
    return {"eq": x == v, "ne": x != v, "gt": x > v, "gte": x >= v, "lt": x < v, "lte": x <= v}[c.op]


def compile_rule(rule: Rule) -> Column:
    """AND of all conditions; a rule without conditions always matches."""
    return reduce(lambda a, b: a & b, [compile_condition(c) for c in rule.conditions], F.lit(True))


def duration_ms_rounded() -> Column:
    """round(duration_s, 3), half-up on the exact microsecond count."""
    return F.expr("(greatest(last_seen_us - first_seen_us, 0) + 500) div 1000").cast("double") / F.lit(1000.0)


def rule_evidence() -> Column:
    return F.to_json(F.struct(
        F.col("src_ip"), F.col("dst_ip"), F.col("dst_port"),
        duration_ms_rounded().alias("duration_s"), F.col("total_packets")))


def rule_findings(flows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Every matching rule yields one finding, in rule load order."""
    if not rules:
        return flows.select(*[F.lit(None).cast(t).alias(n) for n, t in _FINDING_TYPES]).limit(0)
    evidence = rule_evidence()
    cand = [
        F.when(compile_rule(r), F.struct(
            F.lit(i).alias("finding_order"), F.lit(r.id).alias("rule_id"), F.lit(r.name).alias("name"),
            F.lit(r.severity).alias("severity"), F.lit(float(r.confidence)).alias("confidence"),
            F.lit(r.description).alias("description")))
        for i, r in enumerate(rules)
    ]
    matched = F.filter(F.array(*cand), lambda x: x.isNotNull())
    return (flows.select(*IDENTITY, evidence.alias("evidence"), F.explode(matched).alias("f"))
            .select(*IDENTITY, "f.finding_order", F.lit(DETECTOR_SIGNATURE).alias("detector"),
                    "f.rule_id", "f.name", "f.severity", "f.confidence", "f.description", "evidence"))


_FINDING_TYPES = (("flow_id", "string"), ("src_ip", "string"), ("dst_ip", "string"),
                  ("src_port", "int"), ("dst_port", "int"), ("protocol", "int"),
                  ("last_seen_us", "long"), ("finding_order", "int"), ("detector", "string"),
                  ("rule_id", "string"), ("name", "string"), ("severity", "string"),
                  ("confidence", "double"), ("description", "string"), ("evidence", "string"))


def rule_findings_longform(flows: DataFrame, rules: list[Rule]) -> DataFrame:
    """The same findings with rules held as data (relational division): a flow matches a rule whose
    conditions all hold on the flow's values. Rules and conditions are one array, the values another, so the
    division is a ``forall`` inside a projection - no unpivoted flows, no join, no shuffle, whatever the number of
    rules. The rules are configuration and travel with the plan."""
    for r in rules:  # same compile-time check as the projection form
        for c in r.conditions:
            if c.field in RULE_FIELDS and c.op not in OPS:
                raise ValueError(f"unknown rule operator: {c.op!r}")
    if not rules:
        return rule_findings(flows, rules)

    def condition(c: Condition) -> Column:
        kind = value_kind(c.value)
        known = c.field in RULE_FIELDS
        return F.struct(
            F.lit(RULE_FIELDS.index(c.field) if known else -1).alias("field"), F.lit(c.op).alias("op"),
            F.lit(kind).alias("kind"), F.lit(float(c.value) if kind == "num" else 0.0).alias("number"),
            F.array(*[F.lit(x) for x in (numeric_members(c.value) if kind == "list" else [])]).cast("array<double>").alias("members"))

    conditions = "array<struct<field:int,op:string,kind:string,number:double,members:array<double>>>"
    table = F.array(*[F.struct(
        F.lit(i).alias("finding_order"), F.lit(r.id).alias("rule_id"), F.lit(r.name).alias("name"),
        F.lit(r.severity).alias("severity"), F.lit(float(r.confidence)).alias("confidence"),
        F.lit(r.description).alias("description"), F.array(*[condition(c) for c in r.conditions]).cast(conditions).alias("conditions"))
        for i, r in enumerate(rules)])

    def holds(c: Column) -> Column:
        x, v, is_num = F.get("_values", c["field"]), c["number"], c["kind"] == "num"
        match = (F.when(c["op"] == "eq", is_num & (x == v)).when(c["op"] == "ne", ~is_num | (x != v))
                 .when(c["op"] == "gt", is_num & (x > v)).when(c["op"] == "gte", is_num & (x >= v))
                 .when(c["op"] == "lt", is_num & (x < v)).when(c["op"] == "lte", is_num & (x <= v))
                 .otherwise((c["kind"] == "list") & F.array_contains(c["members"], x)))
        return (c["field"] >= 0) & F.coalesce(match, F.lit(False))

    values = F.array(*[F.col(f).cast("double") for f in RULE_FIELDS])
    d = flows.select(*IDENTITY, rule_evidence().alias("evidence"), values.alias("_values"))
    matched = F.filter(table, lambda r: F.forall(r["conditions"], holds))
    return (d.select(*IDENTITY, "evidence", F.inline(matched))
            .select(*IDENTITY, "finding_order", F.lit(DETECTOR_SIGNATURE).alias("detector"),
                    "rule_id", "name", "severity", "confidence", "description", "evidence"))


def rule_count(spark, rules: list[Rule]) -> DataFrame:
    """Number of active rules."""
    return rules_table(spark, rules).agg(F.count(F.lit(1)).alias("rule_count"))

import pytest
from conftest import SF0001, make_packets
from pyspark.sql import functions as F

from flowsift.operators import flows as fl
from flowsift.operators import rules as ru
from flowsift.sources.events import packets as events_packets
from flowsift.sources.rulefiles import Condition, Rule, load_rules

GOOD = """
- id: R1
  name: one
  severity: high
  description: d
  conditions:
    - { field: protocol, op: eq, value: 6 }
"""


def test_loader_cases(tmp_path):
    assert load_rules(tmp_path / "missing") == []
    (tmp_path / "a.yaml").write_text(GOOD)
    (tmp_path / "b.yaml").write_text(GOOD.replace("one", "dup"))           # duplicate id: first kept
    (tmp_path / "c.yaml").write_text("not: a list")                      # not a list: skipped
    (tmp_path / "d.yml").write_text("- id: [unclosed")                   # bad YAML: skipped
    (tmp_path / "e.yaml").write_text(GOOD.replace("R1", "R2") + "\n- id: R3\n  name: x\n  severity: bogus\n"
                                     "  description: d\n  conditions: []\n"
                                     "- id: R4\n  name: y\n  severity: low\n  description: d\n  conditions: []\n")
    rules = load_rules(tmp_path)
    assert [r.id for r in rules] == ["R1", "R2"]  # R3 invalid stops e.yaml; R4 never read
    assert rules[0].name == "one" and rules[0].confidence == 0.85


def test_shipped_rules():
    rules = load_rules()
    assert len(rules) == 9 and rules[0].id == "SUSPECTED_DATA_EXFILTRATION"


def test_operator_edge_cases(spark):
    df = spark.createDataFrame([(6, 1.0)], "protocol int, syn_count double")
    c = lambda f, op, v: df.select(ru.compile_condition(Condition(f, op, v)).alias("m")).first().m
    assert c("nope", "ne", 1) is False           # missing field is false, even for ne
    assert c("protocol", "eq", "6") is False     # eq across types
    assert c("protocol", "ne", "6") is True      # ne across types
    assert c("protocol", "gt", "x") is False     # type error
    assert c("protocol", "in", [1, 6]) is True
    assert c("protocol", "in", "6") is False
    with pytest.raises(ValueError):
        ru.compile_condition(Condition("protocol", "bogus", 1))
    assert df.select(ru.compile_rule(Rule("X", "x", "low", "d", ())).alias("m")).first().m is True


def test_golden_rule_counts_and_longform(spark):
    f = fl.flows(events_packets(spark, SF0001))
    rules = load_rules()
    a = ru.rule_findings(f, rules)
    counts = {r.rule_id: r["count"] for r in a.groupBy("rule_id").count().collect()}
    assert counts == {"TCP_NULL_SCAN": 51, "TCP_FIN_SCAN": 104, "TCP_XMAS_SCAN": 45,
                      "TCP_HALF_OPEN_PROBE": 44, "UDP_FLOOD": 55}
    b = ru.rule_findings_longform(f, rules)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_single_packet_udp_is_a_flood(spark):
    p = make_packets(spark, [(1.0, "10.0.0.1", "10.0.0.2", 1, 53, None, 17, 60)])
    ids = [r.rule_id for r in ru.rule_findings(fl.flows(p), load_rules()).collect()]
    assert ids == ["UDP_FLOOD"]
    assert F is not None

"""Plan-shape checks: what Catalyst does with our plans (pushdown, pruning, no shuffles)."""

from conftest import make_packets, office_capture_rows

from flowsift.operators import alerts as al
from flowsift.operators import flows as fl
from flowsift.operators import rules as ru
from flowsift.plans.detect import detect
from flowsift.sources.packets import packet_filter, read_packets
from flowsift.sources.rulefiles import load_rules


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_packet_filter_is_pushed_and_pruned(spark, tmp_path):
    path = str(tmp_path / "packets")
    make_packets(spark, office_capture_rows()).write.parquet(path)
    q = packet_filter(read_packets(spark, path), protocol=6, dst_port_max=1023).select("src_ip", "dst_port")
    plan = _plan(q)
    assert "PushedFilters: [" in plan and "EqualTo(protocol,6)" in plan and "LessThanOrEqual(dst_port,1023)" in plan
    assert "ReadSchema: struct<src_ip:string,protocol:int,dst_port:int>" in plan


def test_rules_are_one_narrow_projection(spark):
    f = fl.flows(make_packets(spark, office_capture_rows()))
    for form in (ru.rule_findings, ru.rule_findings_longform):
        plan = _plan(form(f, load_rules()))
        assert "Exchange" not in plan and "Join" not in plan and "Generate" in plan


def test_listing_is_top_k_and_stats_one_pass(spark):
    d = detect(make_packets(spark, office_capture_rows()))
    assert "TakeOrderedAndProject" in _plan(al.list_alerts(d.alerts, limit=5))
    plan = _plan(al.stats_grouping_sets(d.alerts))
    assert plan.count("Expand") == 1


def test_scan_windows_take_one_exchange_and_one_scan(spark):
    from flowsift.operators import scans as sc

    plan = _plan(sc.scan_findings(fl.flows(make_packets(spark, office_capture_rows()))))
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1 and "Join" not in plan

import ipaddress
import struct

import pytest
from conftest import OFFICE, office_capture_rows
from pyspark.sql import functions as F

from flowsift.plans.detect import detect
from flowsift.sources.pcap import read_captures

FLAG_BITS = {"F": 0x01, "S": 0x02, "R": 0x04, "P": 0x08, "A": 0x10, "U": 0x20}


def _frame(src, dst, proto, sport, dport, flags):
    eth = b"\x00" * 12 + b"\x08\x00"
    if proto == 6:
        l4 = struct.pack("!HHIIBBHHH", sport, dport, 0, 0, 5 << 4,
                         sum(FLAG_BITS[c] for c in (flags or "")), 8192, 0, 0)
    elif proto == 17:
        l4 = struct.pack("!HHHH", sport, dport, 8, 0)
    else:
        l4 = struct.pack("!BBHHH", 8, 0, 0, 0, 0)  # ICMP echo request
    ip = struct.pack("!BBHHHBBH4s4s", 0x45, 0, 20 + len(l4), 1, 0, 64, proto, 0,
                     ipaddress.IPv4Address(src).packed, ipaddress.IPv4Address(dst).packed)
    return eth + ip + l4


def write_pcap(path, rows):
    with open(path, "wb") as f:
        f.write(struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1))
        for ts, s, d, sp, dp, fl, proto, _len in rows:
            fr = _frame(s, d, proto, sp, dp, fl)
            us = int(round(ts * 1_000_000))
            f.write(struct.pack("<IIII", us // 1_000_000, us % 1_000_000, len(fr), len(fr)))
            f.write(fr)


def test_pcap_replay_end_to_end(spark, tmp_path):
    rows = office_capture_rows()
    write_pcap(tmp_path / "office.pcap", rows)
    p = read_captures(spark, str(tmp_path))
    assert p.count() == OFFICE["packets"]
    lens = {r.protocol: r.length for r in p.select("protocol", "length").distinct().collect()}
    assert lens == {6: 54, 1: 42, 17: 42}
    first = p.orderBy("pkt_idx").first()
    assert (first.protocol, first.src_ip, first.dst_ip) == (1, "172.16.9.40", "172.16.0.3")
    d = detect(p)
    assert d.flows.count() == OFFICE["flows"]
    ids = {r.rule_id for r in d.findings.select("rule_id").distinct().collect()}
    assert {"TCP_NULL_SCAN", "HOST_PORT_SCAN", "ICMP_FLOOD"} <= ids
    assert d.alerts.where(F.col("dst_port") == 8443).count() == 0
    from flowsift.sources import alertstore

    table = str(tmp_path / "store")
    alertstore.append_alerts(d.alerts, table)
    stored = alertstore.read_alerts(spark, table)
    assert stored.count() == d.alerts.count()
    assert stored.exceptAll(d.alerts.select(*stored.columns)).count() == 0


def test_missing_capture(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_captures(spark, str(tmp_path / "nope.pcap"))


def test_pcapng_blocks():
    import io
    import struct

    from flowsift.sources.pcap import _pcapng

    def block(kind, body):
        n = 12 + len(body)
        return struct.pack("<II", kind, n) + body + struct.pack("<I", n)

    section = block(0x0A0D0D0A, struct.pack("<IHHq", 0x1A2B3C4D, 1, 0, -1))
    interface = block(1, struct.pack("<HHI", 101, 0, 65535))
    packets = [block(6, struct.pack("<IIIII", 0, 0, 1_000_000 + i, 4, 4) + bytes([69, 0, 0, i])) for i in range(2)]
    f = io.BytesIO(section + interface + b"".join(packets))
    assert list(_pcapng(f, f.read(4))) == [(101, 1_000_000 + i, bytes([69, 0, 0, i])) for i in range(2)]

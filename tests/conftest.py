import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from flowsift.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="flowsift-tests")
    yield s


def make_packets(spark, rows, capture_id="t"):
    """rows: (ts_seconds, src_ip, dst_ip, src_port, dst_port, flags, protocol, length)."""
    from flowsift.schemas import PACKETS

    data = [(capture_id, i, int(round(ts * 1_000_000)), s, d, proto, sp, dp, length, None, fl, 0)
            for i, (ts, s, d, sp, dp, fl, proto, length) in enumerate(rows)]
    return spark.createDataFrame(data, PACKETS)


#: What the office capture below holds.
OFFICE = {"packets": 119, "flows": 35, "findings": {"ICMP_FLOOD": 1, "UDP_FLOOD": 1, "TCP_NULL_SCAN": 31, "HOST_PORT_SCAN": 12}}


def office_capture_rows():
    """A capture of our own: a burst of pings, a name lookup, a probe of 31 ports without flags, a page fetched, and
    a lookup without an answer (one packet of no duration has the rate of a flood)."""
    rows, at = [], 1_650_000_000.25
    for i in range(75):
        rows.append((at + i / 250, "172.16.9.40", "172.16.0.3", None, None, None, 1, 42))
    at += 2
    for way in (0, 1):
        ends = [("172.16.0.21", "172.16.0.2"), (53_100, 53)]
        (a, b), (x, y) = (e[::-1] if way else e for e in ends)
        rows.append((at + way / 100, a, b, x, y, None, 17, 42))
    at += 1
    for i in range(31):
        rows.append((at + i / 50, "172.16.7.7", "172.16.0.21", 45_000, 8_000 + 3 * i, "", 6, 54))
    at += 4
    page = [("S", 0), ("SA", 1), ("A", 0), ("PA", 0), ("A", 1), ("PA", 1), ("A", 0), ("PA", 1), ("A", 0), ("FA", 1)]
    for i, (flags, way) in enumerate(page):
        ends = [("172.16.0.21", "203.0.113.80"), (50_444, 8_443)]
        (a, b), (x, y) = (e[::-1] if way else e for e in ends)
        rows.append((at + i / 8, a, b, x, y, flags, 6, 54))
    rows.append((at + 3, "172.16.0.21", "172.16.0.2", 53_101, 53, None, 17, 42))
    return rows

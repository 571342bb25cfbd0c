"""Exact rows of packet blocks 2, 3 and 6 and of loopback and SLL2 captures; unknown forms raise."""

import struct

import pytest
from test_pcap import _frame

from flowsift.sources.pcap import parse_capture

IP = _frame("10.0.0.1", "10.0.0.2", 6, 1234, 80, "S")[14:]


def block(kind, body):
    body += b"\0" * (-len(body) % 4)
    return struct.pack("<II", kind, 12 + len(body)) + body + struct.pack("<I", 12 + len(body))


def pcapng(path, *blocks, linktype=101, snap=0):
    section = block(0x0A0D0D0A, struct.pack("<IHHq", 0x1A2B3C4D, 1, 0, -1))
    path.write_bytes(section + block(1, struct.pack("<HHI", linktype, 0, snap)) + b"".join(blocks))
    return str(path)


def pcap(path, linktype, frame):
    path.write_bytes(struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, linktype)
                     + struct.pack("<IIII", 5, 7, len(frame), len(frame)) + frame)
    return str(path)


def row(path, idx, ts, length):
    return (path, idx, ts, "10.0.0.1", "10.0.0.2", 6, 1234, 80, length, 64, "S", 0)


def test_packet_blocks(tmp_path):
    n = len(IP)
    p = pcapng(tmp_path / "a.pcapng", block(3, struct.pack("<I", n) + IP), block(6, struct.pack("<IIIII", 0, 0, 9, n, n) + IP),
               block(2, struct.pack("<HHIIII", 0, 0, 0, 11, n, n) + IP), block(3, struct.pack("<I", n) + IP), block(4, b""))
    assert list(parse_capture(p)) == [row(p, i, ts, n) for i, ts in enumerate((0, 9, 11, 11))]
    p = pcapng(tmp_path / "b.pcapng", block(3, struct.pack("<I", n + 60) + IP), snap=n)
    assert list(parse_capture(p)) == [row(p, 0, 0, n)]
    with pytest.raises(ValueError):
        list(parse_capture(pcapng(tmp_path / "c.pcapng", block(6, struct.pack("<IIIII", 1, 0, 9, n, n) + IP))))


@pytest.mark.parametrize("linktype, header", [(0, struct.pack("<I", 2)), (0, struct.pack(">I", 2)), (108, struct.pack(">I", 2)),
                                              (276, struct.pack("!H", 0x0800) + b"\0" * 18)])
def test_link_types(tmp_path, linktype, header):
    p = pcap(tmp_path / "a.pcap", linktype, header + IP)
    assert list(parse_capture(p)) == [row(p, 0, 5_000_007, len(header) + len(IP))]


def test_unknown_link_type_raises(tmp_path):
    with pytest.raises(ValueError, match="link type 147"):
        list(parse_capture(pcap(tmp_path / "a.pcap", 147, IP)))

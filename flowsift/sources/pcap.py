"""Capture files (S2, P3, P4) as a Spark data source.

``spark.read.format("pcap").load(dir_or_file)`` reads a folder of pcap / pcapng files:
one input partition per file, records streamed with constant memory, header fields only
(``struct.unpack``). Each frame becomes one packet row with ``capture_id`` = file path and
``pkt_idx`` = ordinal in the file; frames without IPv4/IPv6 are skipped (P4), a link type that
is not known raises. pcapng packet blocks of types 6, 3 and 2 are read; a simple block (3) has no time
of its own and takes that of the packet before it (0 if there is none). Protocol
classification (P3): TCP 6, UDP 17, ICMPv4 1; ICMPv6, other protocols and non-first
fragments 0. ``length`` is the captured frame length; TCP flags use the letter order
F S R P A U E C N ("SA", "FA", "FPU" ...).
"""

from __future__ import annotations

import glob
import ipaddress
import os
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from flowsift.schemas import PACKETS

FLAG_ORDER = "FSRPAUECN"
NULL, ETH, RAW, LOOP, LINUX_SLL, IPV4_LT, IPV6_LT, LINUX_SLL2 = 0, 1, 101, 108, 113, 228, 229, 276
#: Address families of IP in loopback headers (IPv4; IPv6 of Linux, BSDs and macOS).
IP_FAMILIES = (2, 10, 24, 28, 30)


def _tcp_flags(bits: int) -> str:
    return "".join(ch for i, ch in enumerate(FLAG_ORDER) if bits & (1 << i))


def _ip_packet(buf: bytes, off: int):
    """-> (src, dst, proto, sport, dport, ttl, flags, payload_len) or None when not IP."""
    if len(buf) < off + 1:
        return None
    ver = buf[off] >> 4
    if ver == 4 and len(buf) >= off + 20:
        ihl = (buf[off] & 0x0F) * 4
        ttl, proto = buf[off + 8], buf[off + 9]
        frag = struct.unpack_from("!H", buf, off + 6)[0] & 0x1FFF
        src = str(ipaddress.IPv4Address(buf[off + 12:off + 16]))
        dst = str(ipaddress.IPv4Address(buf[off + 16:off + 20]))
        total = struct.unpack_from("!H", buf, off + 2)[0]
        end = min(len(buf), off + total) if total else len(buf)
        l4 = off + ihl
        first_fragment = frag == 0
    elif ver == 6 and len(buf) >= off + 40:
        proto, ttl = buf[off + 6], buf[off + 7]
        src = str(ipaddress.IPv6Address(buf[off + 8:off + 24]))
        dst = str(ipaddress.IPv6Address(buf[off + 24:off + 40]))
        end = min(len(buf), off + 40 + struct.unpack_from("!H", buf, off + 4)[0])
        l4, first_fragment = off + 40, True
        # walk the common extension headers (hop-by-hop, routing, fragment, destination)
        while proto in (0, 43, 44, 60) and len(buf) >= l4 + 8:
            if proto == 44:
                first_fragment = (struct.unpack_from("!H", buf, l4 + 2)[0] >> 3) == 0
                nxt, hl = buf[l4], 8
            else:
                nxt, hl = buf[l4], (buf[l4 + 1] + 1) * 8
            proto, l4 = nxt, l4 + hl
    else:
        return None
    sport = dport = None
    flags = None
    payload = 0
    out_proto = 0
    if first_fragment and proto == 6 and len(buf) >= l4 + 14:
        sport, dport = struct.unpack_from("!HH", buf, l4)
        doff = (buf[l4 + 12] >> 4) * 4
        flags = _tcp_flags(((buf[l4 + 12] & 0x01) << 8) | buf[l4 + 13])
        payload, out_proto = max(0, end - (l4 + doff)), 6
    elif first_fragment and proto == 17 and len(buf) >= l4 + 8:
        sport, dport = struct.unpack_from("!HH", buf, l4)
        payload, out_proto = max(0, end - (l4 + 8)), 17
    elif first_fragment and proto == 1 and ver == 4:
        out_proto = 1
    return src, dst, out_proto, sport, dport, (ttl or None), flags, payload


def _l3_offset(linktype: int, buf: bytes) -> int | None:
    if linktype == ETH:
        if len(buf) < 14:
            return None
        off, etype = 14, struct.unpack_from("!H", buf, 12)[0]
        while etype in (0x8100, 0x88A8) and len(buf) >= off + 4:  # VLAN tags
            etype, off = struct.unpack_from("!H", buf, off + 2)[0], off + 4
        return off if etype in (0x0800, 0x86DD) else None
    if linktype == LINUX_SLL:
        return 16 if len(buf) >= 16 and struct.unpack_from("!H", buf, 14)[0] in (0x0800, 0x86DD) else None
    if linktype == LINUX_SLL2:
        return 20 if len(buf) >= 20 and struct.unpack_from("!H", buf, 0)[0] in (0x0800, 0x86DD) else None
    if linktype in (NULL, LOOP):  # NULL: in the byte order of the capturing host
        orders = ("!I",) if linktype == LOOP else ("<I", ">I")
        return 4 if len(buf) >= 4 and any(struct.unpack_from(o, buf, 0)[0] in IP_FAMILIES for o in orders) else None
    if linktype in (RAW, IPV4_LT, IPV6_LT):
        return 0
    raise ValueError(f"link type {linktype} is not known")


def _frames(f) -> Iterator[tuple[int, int, bytes]]:
    """(linktype, ts_us, frame bytes) for classic pcap (both byte orders, µs/ns) and pcapng."""
    head = f.read(4)
    if len(head) < 4:
        return
    magic = struct.unpack("<I", head)[0]
    if magic == 0x0A0D0D0A:
        yield from _pcapng(f, head)
        return
    formats = {0xA1B2C3D4: ("<", 1), 0xD4C3B2A1: (">", 1), 0xA1B23C4D: ("<", 1000), 0x4D3CB2A1: (">", 1000)}
    if magic not in formats:
        raise ValueError("not a pcap or pcapng file")
    e, div = formats[magic]
    rest = f.read(20)
    linktype = struct.unpack(e + "HHiIII", rest)[5] & 0x0FFFFFFF
    while True:
        rh = f.read(16)
        if len(rh) < 16:
            return
        sec, frac, incl, _orig = struct.unpack(e + "IIII", rh)
        data = f.read(incl)
        yield linktype, sec * 1_000_000 + frac // div, data


def _pcapng(f, first4: bytes) -> Iterator[tuple[int, int, bytes]]:
    e = "<"
    ifaces: list[tuple[int, int, int]] = []  # (linktype, ticks per second, snap length)
    ts_us = 0
    block = first4
    while True:
        if block is None:
            block = f.read(4)
            if len(block) < 4:
                return
        blen_raw = f.read(4)
        if len(blen_raw) < 4:
            return
        if struct.unpack("<I", block)[0] == 0x0A0D0D0A:
            bom = f.read(4)
            e = "<" if struct.unpack("<I", bom)[0] == 0x1A2B3C4D else ">"
            blen = struct.unpack(e + "I", blen_raw)[0]
            f.read(blen - 12)  # type, length and byte order are read
            ifaces = []
            block = None
            continue
        btype = struct.unpack(e + "I", block)[0]
        blen = struct.unpack(e + "I", blen_raw)[0]
        body = f.read(blen - 8)
        block = None
        if btype == 1:  # interface description
            lt, snap = struct.unpack_from(e + "HxxI", body, 0)
            tps, pos = 1_000_000, 8
            while pos + 4 <= len(body) - 4:
                code, ln = struct.unpack_from(e + "HH", body, pos)
                if code == 0:
                    break
                if code == 9 and ln >= 1:
                    r = body[pos + 4]
                    tps = 2 ** (r & 0x7F) if r & 0x80 else 10 ** r
                pos += 4 + ((ln + 3) // 4) * 4
            ifaces.append((lt, tps, snap))
        elif btype in (2, 3, 6):  # packet (obsolete), simple packet, enhanced packet
            iface = 0 if btype == 3 else struct.unpack_from(e + ("I" if btype == 6 else "H"), body, 0)[0]
            if iface >= len(ifaces):
                raise ValueError(f"packet block of interface {iface}, which is not described")
            lt, tps, snap = ifaces[iface]
            if btype == 3:
                size = struct.unpack_from(e + "I", body, 0)[0]
                yield lt, ts_us, body[4:-4][:min(size, snap or size)]
                continue
            hi, lo, cap = struct.unpack_from(e + "III", body, 4)
            ts_us = ((hi << 32) | lo) * 1_000_000 // tps
            yield lt, ts_us, body[20:20 + cap]


def parse_capture(path: str) -> Iterator[tuple]:
    """Rows of the packet schema for one capture file (frames without IP are skipped)."""
    with open(path, "rb") as f:
        for idx, (lt, ts_us, frame) in enumerate(_frames(f)):
            off = _l3_offset(lt, frame)
            if off is None:
                continue
            ip = _ip_packet(frame, off)
            if ip is None:
                continue
            src, dst, proto, sport, dport, ttl, flags, payload = ip
            yield (path, idx, ts_us, src, dst, proto, sport, dport, len(frame), ttl, flags, payload)


class _FilePartition(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _CaptureReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        if os.path.isdir(self.path):
            files = sorted(p for p in glob.glob(os.path.join(self.path, "**", "*"), recursive=True)
                           if p.endswith((".pcap", ".pcapng", ".cap")))
        else:
            files = sorted(glob.glob(self.path))
        if not files:
            raise FileNotFoundError(f"no capture files at {self.path}")
        return [_FilePartition(p) for p in files]

    def read(self, partition):
        yield from parse_capture(partition.path)


class CaptureDataSource(DataSource):
    @classmethod
    def name(cls):
        return "pcap"

    def schema(self):
        return PACKETS

    def reader(self, schema):
        path = self.options.get("path")
        if not path:
            raise ValueError("load(path) is required")
        return _CaptureReader(path)


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """A folder (or glob) of capture files -> the packet table."""
    if not glob.glob(path) and not os.path.exists(path):
        raise FileNotFoundError(f"capture path not found: {path}")
    from flowsift.session import ship_package

    ship_package(spark)
    spark.dataSource.register(CaptureDataSource)
    return spark.read.format("pcap").load(path)

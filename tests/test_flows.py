from conftest import SF0001, make_packets
from pyspark.sql import functions as F

from flowsift.config import DetectionConfig
from flowsift.functions.keys import with_flow_key
from flowsift.operators import flows as fl
from flowsift.sources.events import packets as events_packets


def test_key_symmetry(spark):
    p = make_packets(spark, [(0.0, "10.0.0.1", "10.0.0.2", 5000, 443, "S", 6, 60),
                             (0.1, "10.0.0.2", "10.0.0.1", 443, 5000, "SA", 6, 60),
                             (0.2, "10.0.0.1", "10.0.0.3", 5000, 443, "S", 6, 60)])
    r = with_flow_key(p).orderBy("pkt_idx").collect()
    assert (r[0].lo_ip, r[0].hi_ip, r[0].lo_port, r[0].hi_port) == (r[1].lo_ip, r[1].hi_ip, r[1].lo_port, r[1].hi_port)
    assert r[0].is_fwd != r[1].is_fwd
    assert r[2].hi_ip == "10.0.0.3"


def test_text_order_of_addresses(spark):
    p = make_packets(spark, [(0.0, "9.0.0.1", "10.0.0.1", 1, 2, None, 17, 60)])
    r = with_flow_key(p).first()
    assert r.lo_ip == "10.0.0.1" and r.is_fwd is False


def test_fin_close(spark):
    """A reset in the middle ends a flow with its packet; what follows on the same ports is another flow."""
    cfg = DetectionConfig(idle_timeout_s=60, active_timeout_s=600)
    ends = ("192.0.2.14", "192.0.2.99", 40_021, 22), ("192.0.2.99", "192.0.2.14", 22, 40_021)
    steps = [(0, 0, "S", 70), (2, 1, "SA", 74), (3, 0, "A", 66), (7, 0, "PA", 190), (8, 1, "R", 60), (9, 0, "S", 70), (13, 1, "FPA", 81)]
    p = make_packets(spark, [(at, *ends[way], flags, 6, size) for at, way, flags, size in steps])
    first, second = sorted(fl.flows(p, cfg).collect(), key=lambda r: r.first_pkt_idx)
    assert (first.total_packets, first.fwd_packets, first.bwd_packets, first.total_bytes) == (5, 3, 2, 460)
    assert (first.syn_count, first.ack_count, first.rst_count, first.psh_count, first.close_reason) == (2, 3, 1, 1, "fin_rst")
    # the packet at exactly t=0 is never a predecessor: gaps of 1, 4 and 1 s enter the IAT statistics
    assert abs(first.iat_mean - 2.0) < 1e-12 and abs(first.iat_std - 2 ** 0.5) < 1e-12
    assert (second.first_pkt_idx, second.total_packets, second.fin_count, second.close_reason) == (5, 2, 1, "fin_rst")


def test_idle_expiry_and_flush(spark):
    cfg = DetectionConfig(idle_timeout_s=5)
    p = make_packets(spark, [(1.0, "10.0.0.1", "10.0.0.2", 1, 2, None, 17, 60),
                             (5.9, "10.0.0.1", "10.0.0.2", 1, 2, None, 17, 60),   # 4.9 s later: same flow
                             (10.9, "10.0.0.1", "10.0.0.2", 1, 2, None, 17, 60),  # exactly 5 s: new flow
                             (11.0, "10.0.0.3", "10.0.0.4", 1, 2, None, 17, 60)])
    rows = sorted((r.first_pkt_idx, r.total_packets) for r in fl.flows(p, cfg).collect())
    assert rows == [(0, 2), (2, 1), (3, 1)]


def test_active_timeout_greedy(spark):
    cfg = DetectionConfig(idle_timeout_s=15, active_timeout_s=20)
    ts = [0.5 + 10 * i for i in range(7)]  # 0.5 .. 60.5, gaps of 10 s
    p = make_packets(spark, [(t, "10.0.0.1", "10.0.0.2", 1, 2, None, 17, 60) for t in ts])
    starts = sorted(r.first_pkt_idx for r in fl.flows(p, cfg).collect())
    assert starts == [0, 2, 4, 6]  # greedy cut at first + 20 s, then again from the cut


def test_bucket_stitching_matches(spark):
    p = events_packets(spark, SF0001)
    base = fl.flows(p).drop("close_reason")
    small = fl.flows(p, DetectionConfig(packet_bucket=7)).drop("close_reason")
    assert base.count() == 314
    assert base.exceptAll(small).count() == 0 and small.exceptAll(base).count() == 0


def test_golden_flow_counts(spark):
    p = events_packets(spark, SF0001)
    assert fl.flows_no_active(p).count() == 311
    f = fl.flows(p)
    assert f.count() == 314
    assert f.agg(F.sum("total_packets")).first()[0] == p.count()


def _sequential_starts(rows, idle_us, active_us):
    """Brute force: the original per-packet tracker with continuous expiry, in arrival order."""
    open_flows, starts = {}, []
    for idx, (ts, s, d, sp, dp, fl_, proto, _len) in enumerate(rows):
        t = int(round(ts * 1_000_000))
        a, b = (s, sp or 0), (d, dp or 0)
        key = (min(a, b), max(a, b), proto)
        f = open_flows.get(key)
        if f is not None and (t - f["last"] >= idle_us or t - f["first"] >= active_us):
            f = None
        if f is None:
            f = {"first": t, "last": t, "start": idx}
            starts.append(idx)
        f["last"] = t
        open_flows[key] = f
        if fl_ and ("F" in fl_ or "R" in fl_):
            open_flows.pop(key)
    return sorted(starts)


def test_sessionizer_matches_sequential_model_with_many_cuts(spark):
    import random

    rnd = random.Random(7)
    rows, t = [], 0.5
    for _ in range(400):
        t += rnd.choice([0.2, 0.5, 1.0, 1.4])
        jitter = rnd.choice([0.0, 0.0, 0.0, -0.7])  # some timestamps go backwards
        host = rnd.choice(["10.0.0.1", "10.0.0.2"])
        flags = rnd.choice([None, None, None, None, None, None, "FA"])
        rows.append((max(0.1, t + jitter), host, "10.0.0.9", 1000, 80, flags, 6, 60))
    cfg = DetectionConfig(idle_timeout_s=1.5, active_timeout_s=2.0, packet_bucket=16)
    p = make_packets(spark, rows)
    got = sorted(r.first_pkt_idx for r in fl.flows(p, cfg).collect())
    assert got == _sequential_starts(rows, cfg.idle_us, cfg.active_us)
    # one long segment needing many active cuts (several frontier rounds of 16)
    rows2 = [(0.5 + 0.25 * i, "10.0.0.1", "10.0.0.9", 1, 2, None, 17, 60) for i in range(400)]
    got2 = sorted(r.first_pkt_idx for r in fl.flows(make_packets(spark, rows2), cfg).collect())
    assert got2 == _sequential_starts(rows2, cfg.idle_us, cfg.active_us)
    assert len(got2) == 50


def test_ten_thousand_cuts_in_logarithmic_rounds(spark):
    """One segment of 10,000 cuts, out of order in places, and short ones beside it."""
    import random

    from flowsift.operators.activecut import active_cuts

    rnd = random.Random(11)
    segments = {}
    for seg, n in ((0, 40_000), (100_000, 3), (200_000, 700)):
        t, packets = 0, [(seg, 0)]
        for i in range(1, n):
            t += rnd.choice([0, 30, 90, 400, 480, 999])
            packets.append((seg + i, max(0, t - rnd.choice([0, 0, 0, 350]))))
        segments[seg] = packets
    want = set()
    for seg, packets in segments.items():
        cut = 0
        for idx, rel in packets:
            if rel >= cut + 1000:
                cut = rel
                want.add((seg, idx))
    rows = [("c", seg, idx, rel) for seg, ps in segments.items() for idx, rel in ps if rel >= 1000 or idx == seg]
    df = spark.createDataFrame(rows, "capture_id string, seg_idx long, pkt_idx long, rel_us long")
    cells = max(r[3] for r in rows) // 1000 + 1
    got, rounds = active_cuts(df, cells, 1000)
    assert {(r.seg_idx, r.cut_idx) for r in got.collect()} == want
    assert len(want) > 10_000 and rounds <= 15


def test_no_python_in_the_sessionizer():
    import inspect

    from flowsift.operators import activecut

    assert not any(word in inspect.getsource(m) for m in (fl, activecut) for word in ("applyInPandas", "mapInPandas", "import pandas"))


def test_cut_windows_read_each_packet_once(spark):
    """A frame that ends at the last row is read anew for each row: quadratic where a cell holds many packets."""
    from flowsift.operators.activecut import successors

    active, n = 1_000, 400
    rel = [0] + [active + (i * 7919) % (5 * active) // 3 * 3 for i in range(1, n)]  # out of order, many at the same time
    rows = [("t", 0, i, r) for i, r in enumerate(rel)]
    s = successors(spark.createDataFrame(rows, "capture_id string, seg_idx long, pkt_idx long, rel_us long"), active)
    assert "unboundedfollowing" not in s._jdf.queryExecution().analyzed().toString().lower()
    want = {i: min((j for j in range(n) if rel[j] >= rel[i] + active), default=None) for i in range(n)}
    got = s.collect()
    assert {r.pkt_idx: r.next_idx for r in got} == want
    first = {i: min((c for c in range(rel[i] // active + 1) if i == min((j for j in range(n) if rel[j] // active >= c))), default=None)
             for i in range(n)}
    assert {r.pkt_idx: r.first_for for r in got} == first

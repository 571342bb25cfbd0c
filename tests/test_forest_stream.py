import numpy as np
import pandas as pd
from conftest import OFFICE, make_packets, office_capture_rows
from pyspark.sql import functions as F

from flowsift.operators import flows as fl
from flowsift.operators import iforest as ifo
from flowsift.session import scratch_path


def test_iforest_scores_outlier_higher(spark, tmp_path):
    rng = np.random.default_rng(0)
    pts = [(i, [float(x) for x in rng.normal(0, 1, 4)]) for i in range(600)] + [(10_000, [8.0, 8.0, 8.0, 8.0])]
    df = spark.createDataFrame(pts, "rid long, x array<double>")
    model = ifo.fit(df.where(F.col("rid") < 600), "rid", n_trees=50)
    scored = {r.rid: r.raw_score for r in ifo.score_frame(df, model).collect()}
    assert all(0.0 < v <= 1.0 for v in scored.values())
    assert scored[10_000] > max(v for k, v in scored.items() if k != 10_000)
    path = str(tmp_path / "model")
    model.save(spark, path)
    back = ifo.IForestModel.load(spark, path)
    again = {r.rid: r.raw_score for r in ifo.score_frame(df, back).collect()}
    assert again == scored
    assert ifo.IForestModel.load(spark, str(tmp_path / "missing")) is None


def test_forest_is_a_function_of_the_rows(spark):
    """Neither partitions nor row order change the trees; rows of equal id and constant features are fine."""
    pts = [(i // 2, [float(i % 7), 5.0, float(i * i % 31)]) for i in range(500)]
    one = ifo.fit(spark.createDataFrame(pts, "rid long, x array<double>").repartition(1), "rid", n_trees=7, max_samples=32)
    two = ifo.fit(spark.createDataFrame(pts[::-1], "rid long, x array<double>").repartition(13), "rid", n_trees=7, max_samples=32)
    key = ["tree_id", "node_id"]
    a, b = (m.nodes.sort_values(key).reset_index(drop=True) for m in (one, two))
    assert a.equals(b) and set(a["tree_id"]) == set(range(7)) and (a["feature"] != 1).all()
    for _, tree in a.groupby("tree_id"):
        size = dict(zip(tree["node_id"], tree["size"]))
        assert size[1] == 32
        inner = tree[tree["feature"] >= 0]["node_id"]
        assert all(size[k] == size[2 * k] + size[2 * k + 1] for k in inner)


def test_forest_pool_is_the_smallest_hashes(spark, monkeypatch):
    import hashlib

    monkeypatch.setattr(ifo, "POOL", 40)
    df = spark.range(1000).select(F.col("id").alias("rid"), F.array(F.col("id").cast("double")).alias("x"))
    got = {int(r.id) for r in ifo.pooled_sample(df, "rid", "x", 3, 40, 1000, 42).select("id").distinct().collect()}
    want = sorted(range(1000), key=lambda i: hashlib.md5(f"{i}|42".encode()).hexdigest())[:40]
    assert got == set(want)


def test_stream_equals_batch(spark):
    from flowsift.streaming.flows import run_to_end

    p = make_packets(spark, office_capture_rows(), capture_id="office")
    pk = scratch_path(spark, "t-stream-pk")
    p.write.parquet(pk)
    progress = []
    s = run_to_end(spark, pk, scratch_path(spark, "t-stream-out"), scratch_path(spark, "t-stream-ck"), progress=progress)
    assert spark.read.parquet(pk).count() == OFFICE["packets"]  # the input folder is only read
    cols = [c for c in fl.FLOW_COLUMNS if c != "close_reason"]
    b = fl.flows(p).select(*cols)
    s = s.select(*cols)
    assert s.count() == OFFICE["flows"]
    from flowsift.streaming.progress import counters

    c = counters(progress)
    assert c["packets_seen"] == OFFICE["packets"] + 1 and c["dropped_late"] == 0  # the sentinel is one more
    assert c["active_flows"] >= 0
    assert b.exceptAll(s).count() == 0 and s.exceptAll(b).count() == 0


def test_scoring_matches_sql_walk_over_saved_nodes(spark, tmp_path):
    """M5 twin: a recursive SQL walk of the saved node table gives the same scores."""
    import duckdb

    rng = np.random.default_rng(3)
    pts = [(i, [float(x) for x in rng.normal(0, 1, 3)]) for i in range(300)]
    df = spark.createDataFrame(pts, "rid long, x array<double>")
    model = ifo.fit(df, "rid", n_trees=20, max_samples=64)
    ours = {r.rid: r.raw_score for r in ifo.score_frame(df, model).collect()}
    path = str(tmp_path / "m")
    model.save(spark, path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW nodes AS SELECT * FROM read_parquet('{path}/model_nodes/*.parquet')")
    con.register("pts", pd.DataFrame({"rid": [p[0] for p in pts], "x": [p[1] for p in pts]}))
    cpsi = float(ifo.c_factor(np.array([model.psi]))[0])
    sql = f"""
    WITH RECURSIVE walk(rid, tree_id, node_id) AS (
      SELECT p.rid, t.tree_id, 1::BIGINT FROM pts p, (SELECT DISTINCT tree_id FROM nodes) t
      UNION ALL
      SELECT w.rid, w.tree_id,
             2 * w.node_id + CASE WHEN p.x[n.feature + 1] <= n.threshold THEN 0 ELSE 1 END
      FROM walk w JOIN nodes n ON n.tree_id = w.tree_id AND n.node_id = w.node_id
      JOIN pts p ON p.rid = w.rid
      WHERE n.feature >= 0)
    SELECT w.rid, pow(2.0, -avg(n.depth + CASE WHEN n.size <= 1 THEN 0.0 WHEN n.size = 2 THEN 1.0
           ELSE 2.0 * (ln(n.size - 1.0) + 0.5772156649015329) - 2.0 * (n.size - 1.0) / n.size END) / {cpsi!r}) AS s
    FROM walk w JOIN nodes n ON n.tree_id = w.tree_id AND n.node_id = w.node_id
    WHERE n.feature < 0 GROUP BY w.rid"""
    theirs = dict(con.execute(sql).fetchall())
    assert set(theirs) == set(ours)
    assert max(abs(theirs[k] - ours[k]) for k in ours) < 1e-6  # paths are summed in millionths


def test_stream_state_across_micro_batches(spark):
    """Packets arrive as four files, one per micro-batch: open flows carry over in state."""
    import time as _time

    from flowsift.streaming.flows import run_to_end

    p = make_packets(spark, office_capture_rows(), capture_id="office")
    pk = scratch_path(spark, "t-stream-mb")
    for lo in range(0, OFFICE["packets"], 23):  # ordered files; each write is its own file set
        p.where((F.col("pkt_idx") >= lo) & (F.col("pkt_idx") < lo + 23)).coalesce(1).write.mode("append").parquet(pk)
        _time.sleep(1.1)  # distinct modification times keep the file order
    s = run_to_end(spark, pk, scratch_path(spark, "t-stream-mb-out"), scratch_path(spark, "t-stream-mb-ck"),
                   max_files_per_trigger=1)
    cols = [c for c in fl.FLOW_COLUMNS if c != "close_reason"]
    b = fl.flows(p).select(*cols)
    s = s.select(*cols)
    assert b.exceptAll(s).count() == 0 and s.exceptAll(b).count() == 0


def test_stream_out_of_order_over_micro_batches(spark):
    """Files whose times run backwards: within the lateness the flows equal batch, beyond it the run raises."""
    import time as _time

    import pytest

    from flowsift.streaming.flows import LateRows, run_to_end

    p = make_packets(spark, office_capture_rows(), capture_id="office")
    p = p.withColumn("ts_us", F.when(F.col("pkt_idx") >= 45, F.col("ts_us") - 40_000_000).otherwise(F.col("ts_us")))
    pk = scratch_path(spark, "t-stream-late")
    for lo in range(0, OFFICE["packets"], 23):
        p.where((F.col("pkt_idx") >= lo) & (F.col("pkt_idx") < lo + 23)).coalesce(1).write.mode("append").parquet(pk)
        _time.sleep(1.1)
    args = lambda n: (spark, pk, scratch_path(spark, f"t-late-out{n}"), scratch_path(spark, f"t-late-ck{n}"))
    s = run_to_end(*args(0), max_files_per_trigger=1, lateness_s=600)
    cols = [c for c in fl.FLOW_COLUMNS if c != "close_reason"]
    b, s = fl.flows(p).select(*cols), s.select(*cols)
    assert b.exceptAll(s).count() == 0 and s.exceptAll(b).count() == 0
    with pytest.raises(LateRows):
        run_to_end(*args(1), max_files_per_trigger=1, lateness_s=0)


def test_stream_scans_equal_batch_when_flows_come_late(spark):
    """19 ports at 80 s and again at 100 s, then a 20th at 85 s in a later micro-batch; a second capture
    with the same source stays apart."""
    import time as _time

    from flowsift.operators import scans as sc
    from flowsift.schemas import FLOWS
    from flowsift.streaming.alerts import run_detection_to_end

    s = 1_000_000
    seen = [("a", t * s, port) for t in (80, 100) for port in range(1, 20)] + [("b", 90 * s, p) for p in range(30, 42)]
    rows = [(c, f"{c}-{i}", t, port) for i, (c, t, port) in enumerate(seen)] + [("a", "late", 85 * s, 20)]
    named = {f.name: f.dataType for f in FLOWS.fields}
    base = spark.createDataFrame(rows, "capture_id string, flow_id string, last_seen_us long, dst_port int").select(
        "*", F.lit("10.0.0.1").alias("src_ip"), F.lit("10.0.0.2").alias("dst_ip"), F.lit(999).alias("src_port"),
        F.lit(6).alias("protocol"), F.col("last_seen_us").alias("first_pkt_idx"))
    flows = base.select(*[(F.col(c) if c in base.columns else F.lit(None)).cast(t).alias(c) for c, t in named.items()])
    path = scratch_path(spark, "t-scan-late")
    for part in (F.col("flow_id") != "late", F.col("flow_id") == "late"):
        flows.where(part).coalesce(1).write.mode("append").parquet(path)
        _time.sleep(1.1)
    got = run_detection_to_end(spark, path, scratch_path(spark, "t-scan-alerts"), scratch_path(spark, "t-scan-ck"), [],
                               max_files_per_trigger=1)
    want = sc.scan_findings(flows)
    assert want.count() == 20
    key = ["src_ip", "dst_port", "rule_id", "description"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))


def test_late_packets_are_kept_and_corrected(spark):
    """A third of the packets come a file later: they lie in the side table, and the corrected flows equal batch."""
    import time as _time

    from flowsift.streaming import late
    from flowsift.streaming.flows import run_to_end

    p = make_packets(spark, office_capture_rows(), capture_id="office")
    pk, dealt = scratch_path(spark, "t-late-pk"), scratch_path(spark, "t-late-dealt")
    file = F.expr("pkt_idx div 40") + F.when(F.col("pkt_idx") % 3 == 0, 1).otherwise(0)
    for i in range(4):
        p.where(file == i).coalesce(1).write.mode("append").parquet(pk)
        _time.sleep(1.1)
    ck = scratch_path(spark, "t-late-ck")
    for _ in range(2):  # the second call finds nothing new
        late.split_late(spark, pk, dealt, ck, lateness_s=600, max_files_per_trigger=1)
    on_time, kept = late.dealt(spark, dealt, "on_time"), late.dealt(spark, dealt, "late")
    newest, late_ids = -1, set()
    for f in range(4):
        own = [i for i in range(OFFICE["packets"]) if i // 40 + (i % 3 == 0) == f]
        late_ids |= {i for i in own if i < newest}
        newest = max(newest, *own)
    assert len(late_ids) > 30 and {r.pkt_idx for r in kept.collect()} == late_ids
    assert on_time.count() == OFFICE["packets"] - len(late_ids)
    flows = run_to_end(spark, f"{dealt}/on_time/*", scratch_path(spark, "t-late-flows"), scratch_path(spark, "t-late-flow-ck"),
                       max_files_per_trigger=1)
    cols = [c for c in fl.FLOW_COLUMNS if c != "close_reason"]
    got, want = late.corrected_flows(flows, on_time, kept).select(*cols), fl.flows(p).select(*cols)
    assert flows.select(*cols).exceptAll(want).count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_state_is_dealt_into_slots(spark):
    """Three thousand open flows, two packets of each in two micro-batches: the tracker is called per slot of keys."""
    import time as _time

    from flowsift.streaming.flows import SLOTS, run_to_end
    from flowsift.streaming.progress import counters

    n = 3_000
    rows = [(1_000.0 + 5 * again, f"10.1.{i // 200}.{i % 200}", "10.9.9.9", 40_000, 443, "A", 6, 60 + i % 7)
            for again in (0, 1) for i in range(n)]
    p = make_packets(spark, rows)
    pk = scratch_path(spark, "t-slots")
    for part in (F.col("pkt_idx") < n, F.col("pkt_idx") >= n):
        p.where(part).coalesce(1).write.mode("append").parquet(pk)
        _time.sleep(1.1)
    progress = []
    s = run_to_end(spark, pk, scratch_path(spark, "t-slots-out"), scratch_path(spark, "t-slots-ck"), max_files_per_trigger=1,
                   progress=progress)
    held = [sum(o["numRowsTotal"] for o in r["stateOperators"]) for r in progress]
    fed = [i for i, r in enumerate(progress) if r["numInputRows"] == n]
    assert len(fed) == 2 and max(held) <= SLOTS + 1 < n
    assert [counters(progress[:i + 1])["active_flows"] for i in fed] == [n, n]
    cols = [c for c in fl.FLOW_COLUMNS if c != "close_reason"]
    b, s = fl.flows(p).select(*cols), s.select(*cols)
    assert s.count() == n and b.exceptAll(s).count() == 0 and s.exceptAll(b).count() == 0


def test_trees_draw_numbers_not_vectors(spark):
    """Each tree's rows are the smallest hashes of the pool, ties by vector; no vector is ranked once per tree."""
    import hashlib
    import re

    md5 = lambda *parts: hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()
    pts = [(i // 3, [float(i * 37 % 11), float(i % 5)]) for i in range(90)] + [(None, [9.0, 9.0])]
    s = ifo.pooled_sample(spark.createDataFrame(pts, "rid long, x array<double>"), "rid", "x", 4, 20, len(pts), 42)
    got = sorted((r.tree_id, r.id or "", tuple(r.x)) for r in s.collect())
    want = []
    for tree in range(4):
        ranked = sorted((md5(*([] if i is None else [i]), tree, 42), str("" if i is None else i), tuple(x)) for i, x in pts)
        want += [(tree, i, x) for _, i, x in ranked[:20]]
    assert got == sorted(want)
    lines = s._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: re.search(r"[A-Z]", line).start()
    top = next(i for i, line in enumerate(lines) if line[depth(line):].startswith("Window "))
    below = [lines[top]]
    for line in lines[top + 1:]:
        if depth(line) <= depth(lines[top]):
            break
        below.append(line)
    assert not re.search(r"\bx#", "\n".join(line for line in below if "Relation" not in line))


def test_tracker_packs_packets_as_they_come():
    """A flood key's batches are not kept side by side: each is let go before the one after the next comes."""
    import gc
    import json
    import weakref

    from flowsift.config import DEFAULT_CONFIG
    from flowsift.streaming import flows as sf

    class State:
        value, exists, hasTimedOut = None, False, False

        def getCurrentWatermarkMs(self):
            return 0

        def update(self, value):
            self.value = value

        def setTimeoutTimestamp(self, ms):
            self.due = ms

    given = []

    def batches():
        for i in range(50):
            n = 100
            b = pd.DataFrame({"capture_id": "c", "lo_ip": "1.1.1.1", "hi_ip": "2.2.2.2", "lo_port": 1, "hi_port": 2, "protocol": 17,
                              "pkt_idx": range(i * n, i * n + n), "ts_us": 1_000_000, "is_fwd": i % 2 == 0, "length": 60,
                              "src_ip": "1.1.1.1", "dst_ip": "2.2.2.2", "src_port0": 1, "dst_port0": 2, "term": False,
                              **dict.fromkeys(sf.FLAGS, 1)})
            given.append(weakref.ref(b))
            gc.collect()
            assert sum(r() is not None for r in given) <= 2
            yield b

    state = State()
    out = pd.concat(list(sf._tracker(DEFAULT_CONFIG)((0,), batches(), state)))
    flow, = json.loads(state.value[0])
    assert len(out) == 1 and flow["start"] == 0 and flow["open"] == ["1.1.1.1", "2.2.2.2", 1, 2]
    assert [m[0] for m in flow["m"].values()] == [2_500, 2_500, 4_999] and flow["flags"] == [5_000] * len(sf.FLAGS)


def test_flow_pieces_across_calls_are_exact():
    """Sums over pieces: squares beyond 64 bits, gaps, active cuts and a FIN, in one call and in two, by hand."""
    from flowsift.streaming.flows import FLAGS, _fold

    key = ("c", "1.1.1.1", "2.2.2.2", 1, 2, 6)
    times, big = [0, 5, 9, 14, 20, 50, 51, 52], 1 << 45
    frame = pd.DataFrame([(*key, i, 1_000 + t, True, big + i, i == 6, *[i] * len(FLAGS)) for i, t in enumerate(times)],
                         columns=["capture_id", "lo_ip", "hi_ip", "lo_port", "hi_port", "protocol", "pkt_idx", "ts_us",
                                  "is_fwd", "length", "term", *FLAGS])
    want = [(0, 2, "active_timeout"), (3, 4, "expired"), (5, 6, "fin_rst")]  # active 12, idle 20
    for cuts in ([8], [1, 8], [4, 8], [6, 8], [7, 8]):
        flows, rows, at = {}, [], 0
        for end in cuts:
            rows += _fold(flows, iter([frame.iloc[at:end]]), 20, 12, 0)
            at = end
        assert [(r[6], r[14]) for r in rows] == [(a, why) for a, _, why in want]
        for r, (a, b, _) in zip(rows, want):
            lengths, gaps = [big + i for i in range(a, b + 1)], [times[i + 1] - times[i] for i in range(a, b)]
            assert r[15:20] == tuple(map(str, (b - a + 1, sum(lengths), sum(x * x for x in lengths), min(lengths), max(lengths))))
            assert r[25:28] == tuple(map(str, (len(gaps), sum(gaps), sum(x * x for x in gaps))))
            assert r[30:] == (sum(range(a, b + 1)),) * len(FLAGS)
        assert flows[key]["start"] == 7 and flows[key]["m"]["fl"][:2] == [1, big + 7]


def test_stream_takes_times_at_and_before_the_epoch(spark):
    """Packets from 300 s before the epoch, at it and after it: flows and scans of the streams equal batch."""
    import time as _time

    from flowsift.operators import scans as sc
    from flowsift.streaming.alerts import run_scans_to_end
    from flowsift.streaming.flows import run_to_end

    rows = [(-300.0 + 7.5 * i, "10.0.0.1", "10.0.0.2", 1000 + i % 3, 80, "A", 6, 60) for i in range(60)]
    rows += [(t + p / 100, "10.0.0.9", "10.0.0.2", 4000, p, "S", 6, 54) for t in (-900.0, -0.1) for p in range(1, 30)]
    p = make_packets(spark, sorted(rows))
    pk, files = scratch_path(spark, "t-epoch"), scratch_path(spark, "t-epoch-flows")
    cols = [c for c in fl.FLOW_COLUMNS if c != "close_reason"]
    b = fl.flows(p)
    for i in range(3):
        p.where(F.expr(f"pkt_idx div 40 = {i}")).coalesce(1).write.mode("append").parquet(pk)
        b.where(F.expr(f"first_pkt_idx div 40 = {i}")).coalesce(1).write.mode("append").parquet(files)
        _time.sleep(1.1)
    s = run_to_end(spark, pk, scratch_path(spark, "t-epoch-out"), scratch_path(spark, "t-epoch-ck"), max_files_per_trigger=1)
    b, s = b.select(*cols), s.select(*cols)
    assert b.exceptAll(s).count() == 0 and s.exceptAll(b).count() == 0
    found = run_scans_to_end(spark, files, scratch_path(spark, "t-epoch-scans"), scratch_path(spark, "t-epoch-sck"),
                             max_files_per_trigger=1)
    want = sc.scan_findings(spark.read.parquet(files))
    key = ["flow_id", "rule_id", "description"]
    assert want.count() > 10
    assert sorted(map(tuple, found.select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))


def test_stream_of_times_before_the_epoch_alone_is_flushed(spark):
    from flowsift.streaming.flows import run_to_end

    p = make_packets(spark, [(-90_000.0 + i, "10.0.0.1", "10.0.0.2", 1000, 80, "A", 6, 60) for i in range(10)])
    pk = scratch_path(spark, "t-before")
    p.coalesce(1).write.parquet(pk)
    s = run_to_end(spark, pk, scratch_path(spark, "t-before-out"), scratch_path(spark, "t-before-ck"))
    assert [r.total_packets for r in s.collect()] == [10]


def test_late_split_gives_one_file_a_micro_batch(spark):
    """A file that is read by several tasks stays one file, and a packet exactly by the lateness behind is late."""
    import time as _time

    from flowsift.streaming import late
    from flowsift.streaming.flows import run_to_end

    n = 4_000
    rows = [(1_000.0 + i / 10 + (0 if i < n // 2 else 500), "10.0.0.%d" % (i % 50), "10.9.9.9", 40_000, 443, "A", 6, 60 + i % 7)
            for i in range(n)]
    at = rows[n // 2 - 1][0] - 100
    rows[n // 2 + 10] = (at, *rows[n // 2 + 10][1:])
    p = make_packets(spark, rows)
    pk, dealt = scratch_path(spark, "t-one-pk"), scratch_path(spark, "t-one-dealt")
    for i in range(2):
        (p.where(F.expr(f"pkt_idx div {n // 2} = {i}")).coalesce(1).write.mode("append")
         .option("parquet.block.size", 8_000).option("parquet.page.size", 2_000).parquet(pk))
        _time.sleep(1.1)
    kept = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for c in kept:
        spark.conf.set(c, "8k")
    try:
        late.split_late(spark, pk, dealt, scratch_path(spark, "t-one-dck"), 100, max_files_per_trigger=1)
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    files = spark.read.parquet(f"{dealt}/on_time/*").select(F.input_file_name().alias("f")).distinct().count()
    on_time, side = late.dealt(spark, dealt, "on_time"), late.dealt(spark, dealt, "late")
    assert files == 2 and [r.pkt_idx for r in side.collect()] == [n // 2 + 10]
    flows = run_to_end(spark, f"{dealt}/on_time/*", scratch_path(spark, "t-one-flows"), scratch_path(spark, "t-one-ck"),
                       max_files_per_trigger=1, lateness_s=100)
    cols = [c for c in fl.FLOW_COLUMNS if c != "close_reason"]
    got, want = late.corrected_flows(flows, on_time, side).select(*cols), fl.flows(p).select(*cols)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_takes_packets_without_a_length(spark):
    """As in batch, a packet without a length belongs to its flow's times and flags, not to its counts of packets and bytes."""
    from flowsift.streaming.flows import run_to_end

    p = make_packets(spark, office_capture_rows(), capture_id="office")
    p = p.withColumn("length", F.when(F.col("pkt_idx") % 5 != 2, F.col("length")))
    pk = scratch_path(spark, "t-no-length")
    p.coalesce(1).write.parquet(pk)
    s = run_to_end(spark, pk, scratch_path(spark, "t-no-length-out"), scratch_path(spark, "t-no-length-ck"))
    cols = [c for c in fl.FLOW_COLUMNS if c != "close_reason"]
    b, s = fl.flows(p).select(*cols), s.select(*cols)
    assert s.agg(F.sum("total_packets")).first()[0] < OFFICE["packets"]
    assert b.exceptAll(s).count() == 0 and s.exceptAll(b).count() == 0

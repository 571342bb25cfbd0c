"""The operators against brute force and stated properties."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from flowsift.llm import ann, hashing, hilbert, licenses, linededup, mixing, neardup, packing, recompress, secrets, toxicity
from flowsift.llm.graph import components
from flowsift.llm.queries import QUERIES, tokenizer_path
from flowsift.llm.sql import ORACLE

SF = "/root/testdata/sf0.001"


def texts(seed: int, n: int) -> list[str]:
    """Random texts with shared passages, runs of one word, and near copies."""
    r = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    passages = [[r.choice(vocabulary) for _ in range(r.randint(40, 130))] for _ in range(4)]
    passages.append(["same"] * 90)
    out: list[list[str]] = []
    for _ in range(n):
        words: list[str] = []
        for _ in range(r.randint(1, 3)):
            words += [r.choice(vocabulary) for _ in range(r.randint(0, 60))] + (r.choice(passages) if r.random() < 0.6 else [])
        if out and r.random() < 0.3:
            words = list(r.choice(out))
            for _ in range(r.randint(0, 6)):
                if words:
                    words[r.randrange(len(words))] = r.choice(vocabulary)
        out.append(words)
    return [" ".join(w) for w in out]


def test_recompression_finds_every_repeat(spark):
    t = texts(1, 120)
    docs = spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")
    got = {r.doc_id: r for r in recompress.substring_dedup(docs).collect()}
    first: dict[tuple, int] = {}
    for i, x in enumerate(t):
        w = x.split()
        for p in range(len(w) - 49):
            first.setdefault(tuple(w[p:p + 50]), i)
    for i, x in enumerate(t):
        w = x.split()
        gone = {q for p in range(len(w) - 49) if first[tuple(w[p:p + 50])] < i for q in range(p, p + 50)}
        assert got[i].n_removed == len(gone)
        if gone and got[i].kept is not None:
            assert got[i].kept == " ".join(v for q, v in enumerate(w) if q not in gone)


def test_near_dups_against_all_pairs(spark):
    t = texts(2, 150)
    docs = spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_dups(docs, k=4).collect()}
    sets = [{tuple(w[p:p + 4]) for p in range(max(1, len(w) - 3))} if (w := x.split()) else set() for x in t]
    root = list(range(len(t)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(t)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert got == {i: find(i) for i in range(len(t))}


def test_min_max_signature_estimates():
    f = hashing.constants(200, 6)
    a, b = (hashing.mix(np.arange(x, y, dtype=np.uint64)) for x, y in ((1, 901), (101, 1001)))
    (la, ha), (lb, hb) = neardup.min_max(a, f), neardup.min_max(b, f)
    assert abs(np.mean(np.append(la == lb, ha == hb)) - 0.8) < 0.08


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_components_extended_by_links(spark):
    """Further links join components, and nodes that no link had touched before."""
    from flowsift.llm.graph import components, extended

    label = components(spark.createDataFrame([(1, 2), (3, 4), (4, 5), (8, 9)], "a long, b long"))
    more = spark.createDataFrame([(5, 2), (7, 9), (20, 21), (4, 3)], "a long, b long")
    got = {r.node: r.component for r in extended(label, more).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20}
    assert {r.node: r.component for r in extended(label, more.limit(0)).collect()} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 3, 8: 8, 9: 8}


def test_water_filling_and_takes(spark):
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate([("a", 10), ("b", 400), ("b", 100), ("c", 30), (None, 60)] * 3)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken: dict = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken.setdefault((r.source, r.target, r.source_size), []).append(r.taken)
    for (_, target, size), t in taken.items():
        assert target <= 2 * size and sum(t) == math.floor(target)
    total = sum(k[2] for k in taken)
    assert abs(sum(k[1] for k in taken) - 1.5 * total) < 1e-6


def test_hilbert_keys_are_a_curve():
    bits = 4
    cells = np.array([(x, y, z) for x in range(16) for y in range(16) for z in range(16)])
    key = hilbert.hilbert_keys(cells, bits)
    order = cells[np.argsort(key)]
    assert sorted(key) == list(range(16 ** 3))
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    t = ["The cat's tail, 3.5 cm. É̀ İstanbul", "<|endoftext|> A<|ENDOFTEXT|>", "wörd. word, word.. a,b", "x " * 9000, None, "tab\x0bsep nb ΑΣ ΑΣ."]
    docs = spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")
    p = sorted(packing.pack(docs, tokenizer_path()).collect(), key=lambda r: (r.sequence_id, r.offset))
    tokenizer = Tokenizer.from_file(tokenizer_path())
    for i, x in enumerate(t):
        ids = np.frombuffer(b"".join(r.ids for r in sorted(p, key=lambda r: r.start) if r.doc_id == i), dtype="<u4")
        assert ids.tolist() == tokenizer.encode(x or "", add_special_tokens=False).ids + [2]
    at = [(r.sequence_id * 4096 + r.offset, r.length) for r in p]
    assert [a for a, _ in at] == list(np.cumsum([0] + [n for _, n in at])[:-1])


def test_ann_recall(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(40, 16)).repeat(100, axis=0) + 0.4 * r.normal(size=(4000, 16))
    v = spark.createDataFrame([(i, [float(c) for c in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    got: dict[int, set] = {}
    for row in ann.nearest(v, F.col("id") % 50 == 0, block=512).collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    s = x[::50] @ x.T
    s[np.arange(80), np.arange(0, 4000, 50)] = -np.inf
    best = np.argsort(-s, axis=1)[:, :20]
    assert np.mean([len(got[50 * i] & set(b)) / 20 for i, b in enumerate(best.tolist())]) >= 0.9


def test_ann_exact_beyond_the_windows(spark):
    """Isotropic vectors, which small windows lose: the sweep finds every neighbour, over several sides."""
    r = np.random.default_rng(8)
    x = r.normal(size=(3000, 32))
    v = spark.createDataFrame([(i, [float(c) for c in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    got: dict[int, list] = {}
    for row in ann.nearest(v, F.col("id") % 20 == 0, curves=2, block=64, side=128, most=64).orderBy("query_id", "rank").collect():
        got.setdefault(row.query_id, []).append(row.vec_id)
    s = x[::20] @ x.T
    s[np.arange(150), np.arange(0, 3000, 20)] = -np.inf
    assert [got[20 * i] for i in range(150)] == np.argsort(-s, axis=1)[:, :20].tolist()


def test_ann_windows_grow_to_the_target(spark):
    """Isotropic vectors: narrow windows miss the target and are doubled; the recall measured is the true one."""
    r = np.random.default_rng(9)
    x = r.normal(size=(3000, 16))
    v = spark.createDataFrame([(i, [float(c) for c in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    rows = ann.usable(v, "vec_id", "embedding")
    entries = ann.scratch(ann.classes(rows, 20, F.col("id") % 20 == 0), "t-entries")
    o = ann.scratch(ann.ordered(entries, 4, 5), "t-places")
    found, share, block = ann.windows(o, entries, 20, 64, 0.95, 1 << 16)
    assert block > 64 and 0.95 <= share <= 1
    narrow, low, _ = ann.windows(o, entries, 20, 64, 0.95, 64)
    assert low < 0.9
    got: dict[int, set] = {}
    for row in ann.nearest(v, F.col("id") % 20 == 0, curves=4, block=64).collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    s = x[::20] @ x.T
    s[np.arange(150), np.arange(0, 3000, 20)] = -np.inf
    best = np.argsort(-s, axis=1)[:, :20]
    assert np.mean([len(got[20 * i] & set(b)) / 20 for i, b in enumerate(best.tolist())]) >= 0.9


def test_ann_has_no_nested_loop(spark):
    r = np.random.default_rng(2)
    v = spark.createDataFrame([(i, [float(c) for c in r.normal(size=4)]) for i in range(200)], "vec_id long, embedding array<double>")
    entries = ann.scratch(ann.classes(ann.usable(v, "vec_id", "embedding"), 5, F.col("id") % 20 == 0), "t-entries")
    o = ann.scratch(ann.ordered(entries, 2, 5), "t-places")
    found = ann.search(o, 5, 64)
    rest = ann.sweep(o.where("curve = 0").drop("curve"), ann.best_rows(found, entries, 5), entries, 5, 64)
    for d in (found, rest):
        plan = d._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_license_blocks(spark):
    filler = " ".join(f"filler{i}" for i in range(300))
    notice = licenses.TEMPLATES["gpl-3.0-notice"].replace("program", "library")
    docs = spark.createDataFrame([(0, f"{filler} {notice} {filler}"), (1, filler), (2, "MIT license, mit License"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.license_scan(docs).collect()}
    assert "gpl-3.0-notice" in {m.label for m in got[0].matches} and not got[1].matches and not got[3].hits
    assert [h.at for h in got[2].hits] == [0, 2]


def test_line_dedup_spares_copies(spark):
    rows = [(i, f"unique {i} alpha beta gamma\nshared banner line", f"s{i % 10}") for i in range(40)]
    rows += [(100 + i, "a copied page\nwith two lines", f"s{i % 10}") for i in range(20)]
    got = {r.doc_id: r._l_kept for r in linededup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[3] == ["unique 3 alpha beta gamma"] and got[105] == ["a copied page", "with two lines"]


def test_secret_battery(spark):
    r = random.Random(4)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    key = "".join(r.choice(alphabet) for _ in range(64))
    rows = [(i, f"the quick brown fox jumps over a lazy dog und die donau fahrt mit dampf zur gesellschaft {i}") for i in range(50)]
    rows += [(100, f"before {key} after"), (101, "a" * 64), (102, "donaudampfschifffahrtsgesellschaft"), (103, "API_KEY = 'abcdefgh1' ſecret=12345678")]
    got = {x.doc_id: x for x in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s.start, s.stop) for s in got[100].found] == [(7, 71)]
    assert not got[101].found and not got[102].found and [(s.start, s.kind, s.stop) for s in got[103].base] == [(0, 0, 20)]
    p = [secrets.battery("".join(r.choice(alphabet) for _ in range(80)), alphabet) for _ in range(300)]
    assert sum(min(x) < 0.001 for x in p) <= 6


def test_toxicity_counterfactuals(spark):
    r = random.Random(5)
    words = [f"n{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(900):
        w = [r.choice(words) for _ in range(20)]
        y = int(i % 4 == 0)
        w += ["vile"] * y + (["muslims"] if (r.random() < (0.7 if y else 0.05)) else [])
        rows.append((i, " ".join(w) + "."))
        labels.append((i, 1, y))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert model.score("vile n1 n2") >= 0.7 > model.score("muslims n1 n2") and model.score("christians n1") < 0.7
    assert abs(model.score("muslims") - model.score("jews")) < 0.1


def test_every_query_runs_and_sql_matches(spark):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    for name, query in QUERIES.items():
        got = query(spark, SF)
        rows = got.collect()
        if name in ORACLE:
            want = con.sql(ORACLE[name])
            columns = sorted(want.columns)
            assert columns == sorted(got.columns)
            norm = lambda rs: sorted(repr(x) for x in rs)
            theirs = [tuple(dict(zip(want.columns, x))[c] for c in columns) for x in want.fetchall()]
            assert norm([tuple(r[c] for c in columns) for r in rows]) == norm(theirs), name


def test_packing_words_equal_whole_tokenizer():
    """Words cut here give the ids of the whole text: marks, contractions, digits, case, other scripts."""
    words = packing.Words(tokenizer_path())
    assert words.known
    r = random.Random(3)
    letters = "abcZQ'sdtlrevm019.,!\"#<|>éİΣςσßЖжñ中文あ한́ \x1c\x85-_ ǅŉªԱ\U0001f642­ﬁ"
    texts = ["".join(r.choices(letters, k=r.randint(0, 40))) for _ in range(3000)]
    texts += ["", "don't 'tis WE'LL!", "a<|endoftext|>B C", "été, naïve...", "x" * 3000]
    for text in texts:
        whole = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert words.ids([packing._split(text.encode())]) == [np.array(whole, dtype="<u4").tobytes()], text


def test_packing_small_memory_and_long_lanes(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 3)
    words, r = packing.Words(tokenizer_path()), random.Random(6)
    for _ in range(60):
        texts = [" ".join(r.choice("abcdefghij") * r.randint(1, 3) for _ in range(r.randint(0, 12))) for _ in range(4)]
        whole = [np.array(words.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
        assert words.ids([packing._split(t.encode()) for t in texts]) == whole
    monkeypatch.setattr(packing, "LANE", 5)
    ids, n = np.arange(40), np.array([1, 5, 6, 17, 11])
    table = packing.projection(np.arange(40))
    got = packing.vectors(ids, n, table)
    ends = np.cumsum(n)
    for row, a, b in zip(got, ends - n, ends):
        signs = np.array([[(int(x) >> (16 * k)) & 0xFFFF for k in range(packing.DIMENSIONS)] for x in table[a:b]])
        assert np.allclose(row, signs.mean(axis=0) - 1)

"""Texts of very many tokens or lines: time in proportion to them, and the right result."""

import random
import time

from flowsift.llm import linededup, secrets

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
PROSE = "the quick brown fox jumps over a lazy dog und die donau fahrt mit dampf zur gesellschaft"


def test_a_hundred_thousand_tokens(spark):
    r = random.Random(1)
    tokens = ["".join(r.choices(ALPHABET, k=40)) for _ in range(20_000)]
    rows = [(i, f"{PROSE} {i}") for i in range(300)] + [(1000, " ".join(tokens)), (1001, "word " * 100_000)]
    t0 = time.time()
    got = {x.doc_id: x for x in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert time.time() - t0 < 120
    # more random tokens than prose: they are still found
    assert len(got[1000].found) > 0.99 * len(tokens) and not got[1001].found and not any(got[i].found for i in range(300))


def test_outermost_spans_against_brute_force():
    r = random.Random(2)
    for _ in range(300):
        spans = list({tuple(sorted(r.sample(range(20), 2))) for _ in range(r.randint(0, 12))})
        want = sorted(s for s in spans if not any(o != s and o[0] <= s[0] and o[1] >= s[1] for o in spans))
        assert secrets.outermost(spans) == want


def brute(rows, min_sites, spare_copies_only):
    """Lines kept of each row, by sets of sites."""
    sites: dict[str, set] = {}
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            if line.strip(" \t\x0b\x0c\r"):
                sites.setdefault(line.strip(" \t\x0b\x0c\r"), set()).add(source)
    out = []
    for _, text, _ in rows:
        if text is None:
            out.append(None)
            continue
        lines = text.split("\n")
        bad = [len(sites.get(x.strip(" \t\x0b\x0c\r"), ())) >= min_sites for x in lines]
        lost, total = sum(len(x.split()) for x, b in zip(lines, bad) if b), len(text.split())
        cut = any(bad) and (lost < total if spare_copies_only else 2 * lost <= total)
        out.append([x for x, b in zip(lines, bad) if not (cut and b)])
    return out


def test_lines_against_brute_force(spark):
    r = random.Random(3)
    pool = [f"shared {i}" for i in range(6)] + ["", "  ", "shared 1 \t"]
    rows = []
    for i in range(150):
        lines = [r.choice(pool) if r.random() < 0.5 else f"own {i} {j} more words" for j in range(r.randint(0, 9))]
        rows.append((i, None if i % 31 == 0 else "\n".join(lines), None if i % 17 == 0 else f"s{r.randrange(12)}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for spare in (False, True):
        got = {x.doc_id: x for x in linededup.line_dedup(docs, min_sites=8, spare_copies_only=spare).collect()}
        for (i, text, _), want in zip(rows, brute(rows, 8, spare)):
            assert got[i]._l_kept == want, i
            assert got[i]._l_lines == (0 if text is None else len(text.split("\n")))


def test_a_hundred_thousand_lines(spark):
    rows = [(i, "\n".join(f"shared {j}" if j % 2 else f"own {i} line {j}" for j in range(100_000)), f"s{i}") for i in range(9)]
    t0 = time.time()
    got = linededup.clean(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert {r.n for r in got.selectExpr("size(split(text, '\n')) AS n").collect()} == {50_000}
    assert time.time() - t0 < 150

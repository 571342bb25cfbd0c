"""Random secrets glued to a name, a query parameter or a path."""

import random

from flowsift.llm import secrets

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def test_glued_secrets(spark):
    r = random.Random(6)
    key = lambda extra: "".join(r.choice(ALPHABET + extra) for _ in range(60)) + "q7"
    std, url, plain = "a+b/" + key("+/"), "a-b_" + key("-_"), key("")
    rows = [(i, f"the quick brown fox jumps over a lazy dog und die donau fahrt mit dampf zur gesellschaft {i}") for i in range(50)]
    cases = [("DB_PASS=", std, ""), ("AWS_SECRET_ACCESS_KEY=", std, "== end"), ("see https://host.example/get?sig=", plain, "&x=1"),
             ("some-long_path-of_words/", url, ""), ("some/longer/path-", std, " end")]
    rows += [(100 + i, a + k + b) for i, (a, k, b) in enumerate(cases)]
    got = {x.doc_id: x for x in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (a, k, _) in enumerate(cases):
        assert [(s.start, s.stop) for s in got[100 + i].found] == [(len(a), len(a) + len(k))], i
    assert not any(got[i].found for i in range(50))

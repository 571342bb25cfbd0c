"""Rows with null or shared ids draw on their own, so each source meets its target."""

from flowsift.llm import mixing


def test_null_and_shared_ids_meet_the_target(spark):
    rows = [(None if i % 2 else 7, " ".join(f"{s}{i}w{j}" for j in range(10)), s) for s in "abc" for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    target = {r.source: r.target for r in mixing.mix(docs).collect()}
    got: dict = {}
    for r in mixing.materialize_mix(docs).collect():
        got.setdefault(r.source, []).append(r.text)
    assert any(t % 2000 for t in target.values())
    for s, t in target.items():
        assert abs(10 * len(got[s]) - t) <= 5
        assert max(map(got[s].count, got[s])) <= 2

"""Near duplicates where ids repeat: rows go by id and text, and no text is lost."""

import duckdb
import pytest

from flowsift.llm import neardup
from flowsift.llm.queries import QUERIES
from flowsift.llm.sql import ORACLE

A = " ".join(f"a{i}" for i in range(120))
A2 = " ".join(f"a{i}" if i != 60 else "other" for i in range(120))
B = " ".join(f"b{i}" for i in range(60))
TABLES = {
    "copy and another text": ([(1, A), (2, A), (2, B)], [(1, A), (2, B)]),
    "both texts have copies": ([(1, A), (2, A), (2, B), (3, B)], [(1, A), (2, B)]),
    "equal rows": ([(4, A), (4, A), (5, B), (5, B), (6, B)], [(4, A), (5, B)]),
    "no id, no words": ([(None, A), (None, A), (7, ""), (7, ""), (8, None), (9, A)], [(None, A), (None, A), (7, ""), (7, ""), (8, None), (9, A)]),
}


@pytest.mark.parametrize("name", TABLES)
def test_keep_one(spark, name):
    rows, want = TABLES[name]
    got = neardup.keep_one(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, k_id string"))
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, want))


def test_alike_texts_of_one_id(spark):
    got = neardup.keep_one(spark.createDataFrame([(2, A), (2, A2), (3, A)], "doc_id long, text string")).collect()
    assert len(got) == 1 and got[0].doc_id == 2


def test_operator_equals_sql_on_shared_ids(spark, tmp_path):
    rows = [(1, A), (2, A), (2, B), (3, B), (4, A2), (5, ""), (5, None), (6, "one two"), (7, "one two"), (7, "one three")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = QUERIES["op6_near_dups"](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE['op6_near_dups']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_one_text_in_many_pairs(spark, monkeypatch):
    """A hub's text goes out once for every PER_SALT pairs: the links do not change."""
    monkeypatch.setattr(neardup, "PER_SALT", 3)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[:i] + ["x"] + words[i + 1:])) for i in range(60)]
    got = neardup.near_dups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0}

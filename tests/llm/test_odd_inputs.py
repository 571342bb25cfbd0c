"""Every operator and stage on odd rows and on an empty table, with the results the docstrings define."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowsift.llm import ann, licenses, linededup, mixing, neardup, packing, quality, recompress, secrets, toxicity
from flowsift.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, row string, k_id string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    words = [f"w{i}" for i in range(3000)]
    base = " ".join(words[:120])
    near = " ".join(words[:60] + ["changed"] + words[61:120])
    texts = [None, "", "   \n\t ", "one", base, base, near, " ".join(words) * 4, base + " tail " + " ".join(words[500:620]),
             " ".join(words[500:620]), "a b c d", "a b c d", "x " * 300, "line one here\nline one here\n" + base]
    rows = [(i, t, "en", ["s1", "s2", None][i % 3], 1, 7, "r", "k") for i, t in enumerate(texts)]
    rows += [rows[4], (None, base, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


LABELS = "doc_id long, quality int, toxic int"
ONE_ROW_EACH = {
    "licenses": licenses.license_scan,
    "substrings": recompress.substring_dedup,
    "mixing": mixing.mix,
    "neardup": neardup.near_dups,
    "linededup": linededup.line_dedup,
    "quality": quality.quality_rules,
    "secrets": secrets.scan,
}


@pytest.mark.parametrize("name", ONE_ROW_EACH)
def test_one_row_each(name, odd, empty):
    op = ONE_ROW_EACH[name]
    assert op(odd).count() == odd.count()
    assert op(empty).count() == 0


def test_null_and_empty_results(odd):
    got = {r.doc_id: r for r in neardup.near_dups(odd, k=4).collect()}
    assert got[0].n_shingles == got[1].n_shingles == got[2].n_shingles == 0 and got[0].component_id == 0 and got[1].kept
    assert got[3].n_shingles == 1 and got[5].component_id == 4 and not got[5].kept and got[11].component_id == 10
    assert got[6].component_id == 4
    none = [r for r in neardup.near_dups(odd, k=4).collect() if r.doc_id is None]
    assert all(r.component_id is None and r.kept for r in none) and len(none) == 2
    gone = {r.doc_id: r for r in recompress.substring_dedup(odd).collect()}
    assert gone[0].n_words == 0 and gone[5].n_removed == 120 and gone[9].n_removed == 120
    assert gone[4].n_removed == 0 and gone[12].n_removed == 0 and gone[None].n_removed == 0


def test_packing_odd(odd, empty):
    p = packing.pack(odd, tokenizer_path()).collect()
    assert sum(r.start == 0 for r in p) == odd.count()
    assert any(r.doc_id == 0 and r.doc_tokens == 1 and r.ids == (2).to_bytes(4, "little") for r in p)
    assert packing.pack(empty, tokenizer_path()).count() == 0


def test_toxicity_odd(spark, odd, empty):
    labels = spark.createDataFrame([(None, 1, 1), (3, 1, None), (4, 1, 0)], LABELS)
    none = spark.createDataFrame([], LABELS)
    for docs, known in ((odd, labels), (odd, none), (empty, labels), (empty, none)):
        model = toxicity.train(docs, known)
        d = toxicity.score(docs, model).collect()
        assert len(d) == docs.count() and all(0 <= r.score <= 1 for r in d)


def test_ann_odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [1.0, 0.0]), (8, [0.5, 0.5]), (None, [1.0, 1.0]), (7, [1.0, 0.0]), (20, [1.0, 0.0]), (40, [3.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.nearest(v, F.col("id") % 20 == 0, k=2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 7, 1.0), (0, 2, 20, 1.0), (20, 1, 0, 1.0), (20, 2, 7, 1.0)]
    assert ann.nearest(v.limit(0), F.col("id") % 20 == 0).count() == 0


def test_pipeline_stages_odd(spark, odd, empty, tmp_path):
    spark.createDataFrame([(4, 1, 0), (3, 0, 1)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, docs, str(tmp_path))
            assert got.columns == docs.columns
            got.count()

"""Pages that are mostly boilerplate lose it in the pipeline; copies stay whole."""

from flowsift.llm import linededup


def test_clean_cuts_mostly_boilerplate(spark):
    banner = "a long shared banner line of many words that stands on every site"
    rows = [(i, f"own {i}\n{banner}", f"s{i % 10}") for i in range(40)] + [(100 + i, banner, f"s{i % 10}") for i in range(10)]
    got = {r.doc_id: r.text for r in linededup.clean(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i] == f"own {i}" for i in range(40)) and all(got[100 + i] == banner for i in range(10))

import duckdb
from conftest import SF0001

import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = {r.rule_id: r.n_alerts for r in df.collect()}
    assert rows == {"TCP_NULL_SCAN": 51, "TCP_FIN_SCAN": 104, "TCP_XMAS_SCAN": 45,
                    "TCP_HALF_OPEN_PROBE": 44, "UDP_FLOOD": 55}


def test_every_oracle_has_a_query():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


def test_sample_queries_match_duckdb(spark):
    con = duckdb.connect()
    for t in ("events", "labels", "documents", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    for name in ("flow_features", "alerts", "roc_auc", "training_clean"):
        s = entry.queries()[name](spark, SF0001).toPandas()
        d = con.execute(entry.oracle_sql()[name]).df()
        assert sorted(s.columns) == sorted(d.columns)
        key = sorted(s.columns)
        s = s[key].sort_values(key).reset_index(drop=True)
        d = d[key].sort_values(key).reset_index(drop=True)
        assert len(s) == len(d)
        for c in key:
            assert [repr(x) for x in s[c].tolist()] == [repr(x) for x in d[c].tolist()], (name, c)

import pytest
from pyspark.sql import functions as F

from flowsift.config import CSV_COLUMN_MAP
from flowsift.sources.cicflow import clean, read_labelled_csv

HEADERS = [src for src, _ in CSV_COLUMN_MAP]


def _write(path, rows, headers=HEADERS):
    lines = [",".join(headers)] + [",".join(r) for r in rows]
    path.write_text("\n".join(lines) + "\n")


def _row(label, **over):
    vals = {h: "10" for h in HEADERS}
    vals["Label"] = label
    vals.update(over)
    return [vals[h] for h in HEADERS]


def test_labels_and_totals(spark, tmp_path):
    p = tmp_path / "a.csv"
    _write(p, [_row("BENIGN"), _row("DDoS"), _row("PortScan")])
    df = clean(read_labelled_csv(spark, [str(p)]))
    rows = sorted((r.label_detail, r.label, r.total_packets, r.total_bytes) for r in df.collect())
    assert rows == [("BENIGN", 0, 20.0, 20.0), ("DDoS", 1, 20.0, 20.0), ("PortScan", 1, 20.0, 20.0)]


def test_padded_headers_and_infinity(spark, tmp_path):
    p = tmp_path / "b.csv"
    _write(p, [_row("BENIGN", **{"Flow Bytes/s": "Infinity"}), _row("BENIGN", **{"Flow Bytes/s": "500.0"})],
           headers=[f" {h} " for h in HEADERS])
    df = clean(read_labelled_csv(spark, [str(p)]))
    assert [r.bytes_per_s for r in df.collect()] == [500.0]


def test_concat_missing_file_and_column(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    _write(a, [_row("BENIGN")])
    _write(b, [_row("BENIGN"), _row("Bot")])
    df = read_labelled_csv(spark, [str(a), str(b)])
    assert df.count() == 3 and df.where(F.col("label") == 1).count() == 1
    with pytest.raises(FileNotFoundError):
        read_labelled_csv(spark, [str(tmp_path / "nope.csv")])
    c = tmp_path / "c.csv"
    _write(c, [_row("BENIGN")[:-1]], headers=HEADERS[:-1])
    with pytest.raises(ValueError, match="Label"):
        read_labelled_csv(spark, [str(c)])


def test_stratified_split_exact(spark):
    from flowsift.operators.training import stratified_split

    df = spark.range(0, 1003).select(F.col("id").cast("string").alias("rid"),
                                     (F.col("id") % 10 == 0).cast("int").alias("label"))
    s = stratified_split(df, "rid")
    got = {(r.label, r.split): r["count"] for r in s.groupBy("label", "split").count().collect()}
    assert got[(1, "test")] == 25 and got[(0, "test")] == 226  # round(101 * .25), round(902 * .25)
    again = stratified_split(df, "rid")
    assert s.exceptAll(again).count() == 0

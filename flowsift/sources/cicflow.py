"""Labelled-flow CSVs (S4) and their mapping onto the feature schema.

Files are read as text with a header and no schema inference; headers are trimmed;
missing mapped columns raise a ``ValueError`` naming them; files are concatenated
by name. Feature text is cast with ``try_cast`` (ANSI is on: a plain cast of bad text
raises), so "Infinity"/"NaN"/garbage become +inf/NaN/null and are removed by ``clean``.
"""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.config import BENIGN_LABEL, CSV_COLUMN_MAP, FEATURES

TIME_FEATURES = ("duration_s", "iat_mean", "iat_std")


def read_labelled_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """S4 + U1: one or more labelled-flow CSV files -> mapped training rows."""
    frames = []
    for p in paths:
        if not p.startswith(("s3:", "s3a:", "gs:", "abfs:", "hdfs:")) and not Path(p).exists():
            raise FileNotFoundError(f"labelled flow CSV not found: {p}")
        raw = spark.read.option("header", True).option("inferSchema", False).csv(p)
        frames.append(map_columns(raw, source=Path(p).name))
    return reduce(lambda a, b: a.unionByName(b), frames)


def map_columns(raw: DataFrame, source: str = "input", time_unit: str = "as_is") -> DataFrame:
    """Trim headers, check, rename, binarise the label, derive totals.

    ``time_unit="us"`` converts microsecond durations/IATs to seconds (the tool that
    writes these files reports microseconds; the default keeps values as they are)."""
    stripped = raw.toDF(*[c.strip() for c in raw.columns])
    missing = [src for src, _ in CSV_COLUMN_MAP if src not in stripped.columns]
    if missing:
        raise ValueError(f"{source} is missing expected columns: {missing}")
    cols = []
    for src, dst in CSV_COLUMN_MAP:
        c = F.col(f"`{src}`")
        if dst == "label":
            cols.append(c.cast("string").alias("label_detail"))
        else:
            x = F.expr(f"try_cast(`{src}` AS DOUBLE)")
            if time_unit == "us" and dst in TIME_FEATURES:
                x = x / F.lit(1e6)
            cols.append(x.alias(dst))
    mapped = stripped.select(*cols)
    return (mapped
            .withColumn("label", F.when(F.upper(F.coalesce(F.col("label_detail"), F.lit("nan"))) == BENIGN_LABEL,
                                        F.lit(0)).otherwise(F.lit(1)))
            .withColumn("total_packets", F.col("fwd_packets") + F.col("bwd_packets"))
            .withColumn("total_bytes", F.col("fwd_bytes") + F.col("bwd_bytes"))
            .select(*FEATURES, "label", "label_detail"))


def clean(df: DataFrame) -> DataFrame:
    """+-inf and NaN count as missing; rows missing any feature are dropped.

    One condition per feature, ``abs(x) < inf``: false for +-inf and for NaN (NaN sorts
    above every number in Spark), null for null - so the kept rows are exactly the rows
    whose features are all finite. The row stands as one struct behind a generator: the mapping
    below it runs once a row, and no copy of its expressions is pushed into a filter."""
    def finite(row: Column) -> Column:
        return reduce(lambda a, b: a & b, [F.abs(row[f]) < F.lit(float("inf")) for f in FEATURES])

    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.inline(F.filter(F.array(whole), finite)))


def lineitem_as_flow_csv(lineitem: DataFrame) -> DataFrame:
    """Labelled-flow CSV rows (all text, padded headers as in the wild) derived from
    ``lineitem``, so the CSV path runs on the driver's data: duration = linenumber - 1,
    rates are 'Infinity' when the duration is 0, label from the return flag."""
    q, price, disc, tax, ln = (F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount"),
                               F.col("l_tax"), F.col("l_linenumber"))
    dur = (ln - 1).cast("double")
    bwd_pk = F.floor(q / 2).cast("double")
    fwd_len = F.floor(price).cast("double")
    bwd_len = F.floor(price * disc).cast("double")
    inf = F.lit("Infinity")
    cols = {
        " Flow Duration": (ln - 1),
        " Total Fwd Packets": q,
        " Total Backward Packets": bwd_pk,
        "Total Length of Fwd Packets": fwd_len,
        " Total Length of Bwd Packets": bwd_len,
        " Fwd Packet Length Mean": price / q,
        " Fwd Packet Length Std": tax * 1000,
        " Fwd Packet Length Min": disc * 100,
        " Fwd Packet Length Max": q * 10,
        "Bwd Packet Length Mean": (price * disc) / F.greatest(F.lit(1.0), bwd_pk),
        " Bwd Packet Length Std": tax * 100,
        " Bwd Packet Length Min": F.lit(0.0),
        " Bwd Packet Length Max": q,
        " Flow IAT Mean": dur / q,
        " Flow IAT Std": disc * 10,
        "Flow Bytes/s": F.when(dur == 0, inf).otherwise(((fwd_len + bwd_len) / dur).cast("string")),
        " Flow Packets/s": F.when(dur == 0, inf).otherwise(((q + bwd_pk) / dur).cast("string")),
        " Down/Up Ratio": bwd_pk / q,
        "SYN Flag Count": ln % 2,
        " ACK Flag Count": F.col("l_partkey") % 3,
        " FIN Flag Count": (ln % 3 == 0).cast("int"),
        " RST Flag Count": F.lit(0),
        " PSH Flag Count": F.col("l_suppkey") % 2,
        " URG Flag Count": F.lit(0),
        " Label": F.when(F.col("l_returnflag") == "N", F.lit("BENIGN"))
                  .when(F.col("l_returnflag") == "R", F.lit("PortScan")).otherwise(F.lit("DDoS")),
    }
    return lineitem.select(*[c.cast("string").alias(name) for name, c in cols.items()])

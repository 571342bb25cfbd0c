"""The alert table (S5, J1, P14): Parquet batches named by their content, a manifest of those that
are committed, and an append-only acknowledgement log.

A batch (one batch run, or one micro-batch of a stream) is written to ``alerts/batch=<id>/day=...``
and then committed by a row in ``manifest/batch=<id>``. Readers take committed batches only, so a
write that died half-way is never seen, and appending the same alerts again, or replaying a
micro-batch, rewrites the same folder. Without a name a batch is named by a digest of its rows that
does not depend on their order. Days prune time-ranged listings, rows are sorted by severity and
source inside a file (min/max statistics for the listing's filters), and ids carry a Bloom filter,
so a lookup by id skips the files that cannot hold it. A large day is split by AQE's rebalance, not
sent to one task. An acknowledgement is an appended ``acks`` row; ``current`` joins the log back
(``operators.alerts.current_view``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsift.session import materialize, parquet_if_there
from flowsift.operators.alerts import current_view, get_alert
from flowsift.schemas import ACKS, ALERTS


def content_id(alerts: DataFrame) -> str:
    """A name made from the rows: their number and two order-free digests of them."""
    row = F.xxhash64(*sorted(alerts.columns))
    r = alerts.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(row).alias("x"),
                   F.sum(row.cast("decimal(38,0)")).alias("s")).first()
    return f"c{r.n}-{(r.x or 0) & (1 << 64) - 1:016x}-{int(r.s or 0) & (1 << 64) - 1:016x}"


def append_alerts(alerts: DataFrame, table: str, batch: str | None = None) -> str:
    """Writes and commits one batch; the name it has. Appending it again changes nothing."""
    if batch is None:
        alerts = materialize(alerts, "alert-batch")  # named and written from the same rows
        batch = content_id(alerts)
    (alerts.withColumn("day", F.to_date("created_at")).hint("rebalance", "day")
     .sortWithinPartitions("day", "severity", "src_ip")
     .write.mode("overwrite").partitionBy("day")
     .option("parquet.bloom.filter.enabled#id", "true").parquet(f"{table}/alerts/batch={batch}"))
    written = parquet_if_there(alerts.sparkSession, f"{table}/alerts/batch={batch}", ALERTS)
    if written is not None:
        row = written.agg(F.count(F.lit(1)).alias("n_alerts"), F.min("created_at").alias("first_at"),
                          F.max("created_at").alias("last_at"))
        row.coalesce(1).write.mode("overwrite").parquet(f"{table}/manifest/batch={batch}")
    return batch


def committed(spark: SparkSession, table: str) -> list[str]:
    """Names of the committed batches (a row each, as a table format's log)."""
    found = parquet_if_there(spark, f"{table}/manifest", T.StructType([T.StructField("batch", T.StringType())]))
    return [] if found is None else sorted(r.batch for r in found.select("batch").distinct().collect())


def acknowledge(spark: SparkSession, table: str, ids: list[str], at: dt.datetime | None = None) -> None:
    at = at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    spark.createDataFrame([(i, at) for i in ids], ACKS).write.mode("append").parquet(f"{table}/acks")


def read_alerts(spark: SparkSession, table: str) -> DataFrame:
    """The alerts of all committed batches."""
    names = committed(spark, table)
    if not names:
        return spark.createDataFrame([], ALERTS)
    places = [T.StructField("batch", T.StringType(), True), T.StructField("day", T.DateType(), True)]
    schema = T.StructType([*ALERTS.fields, *places])  # ALERTS stays intact
    return spark.read.schema(schema).parquet(f"{table}/alerts").where(F.col("batch").isin(names)).drop("batch", "day")


def lookup(spark: SparkSession, table: str, alert_id: str) -> DataFrame:
    """The stored alert with this id, or nothing; files whose Bloom filter lacks it are skipped."""
    return get_alert(read_alerts(spark, table), alert_id)


def page_after(spark: SparkSession, table: str, cursor: tuple[dt.datetime, str] | None = None, limit: int = 100,
               **filters) -> DataFrame:
    """O1 on the store: the page that follows ``cursor`` = (created_at, id) of the last row shown. Days after the
    cursor's are not read, and later rows are pushed out of the scan, so a late page reads no more than the first."""
    from flowsift.operators.alerts import list_after

    names = committed(spark, table)
    if not names:
        return spark.createDataFrame([], ALERTS)
    places = [T.StructField("batch", T.StringType(), True), T.StructField("day", T.DateType(), True)]
    rows = spark.read.schema(T.StructType([*ALERTS.fields, *places])).parquet(f"{table}/alerts").where(F.col("batch").isin(names))
    if cursor is not None:
        rows = rows.where(F.col("day") <= F.lit(cursor[0].date()))
    return list_after(rows, cursor, limit, **filters).drop("batch", "day")


def current(spark: SparkSession, table: str) -> DataFrame:
    alerts = read_alerts(spark, table)
    acks = parquet_if_there(spark, f"{table}/acks", ACKS)
    if acks is None:  # none written yet
        acks = spark.createDataFrame([], ACKS)
    return current_view(alerts, acks)


#: Fixed value: the console line's format.
CONSOLE_LINE = "ALERT [%s] %s (%s, conf=%.2f) %s:%d -> %s:%d \u2014 %s"


def console_lines(alerts: DataFrame) -> DataFrame:
    """(id, value), one formatted line per alert (for a text or console sink)."""
    return alerts.select("id", F.format_string(
        CONSOLE_LINE, F.upper("severity"), "name", "detector", "confidence", "src_ip", "src_port", "dst_ip", "dst_port",
        "description").alias("value"))

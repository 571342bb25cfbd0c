"""Alert table queries.

The alert table is append-only Parquet (see ``flowsift.sources.alertstore``); an
acknowledgement is an appended ``acks(id, acked_at)`` row, and the current view is a
left join. Listing and top-k use ``orderBy(...).offset().limit()``, which plans as
``TakeOrderedAndProject`` (per-partition top-(offset+limit), then a merge) - no full sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.config import SEVERITIES

MAX_LIST_LIMIT = 1000
LIVE_BUFFER = 200
#: Largest counts of a dimension that the nested summary carries.
KEPT = 1000


def severity_rank(col: str | Column = "severity") -> Column:
    """Low 0 < medium 1 < high 2 < critical 3 (unknown -> null)."""
    c = F.col(col) if isinstance(col, str) else col
    pos = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), c)
    return F.when(pos > 0, pos - 1).cast("int")


def filter_alerts(alerts: DataFrame, severity: str | None = None, src_ip: str | None = None,
                  detector: str | None = None) -> DataFrame:
    """Optional equality filters, ANDed (pushed down to the Parquet scan)."""
    if severity:
        alerts = alerts.where(F.col("severity") == severity)
    if src_ip:
        alerts = alerts.where(F.col("src_ip") == src_ip)
    if detector:
        alerts = alerts.where(F.col("detector") == detector)
    return alerts


def list_alerts(alerts: DataFrame, limit: int = 100, offset: int = 0, severity: str | None = None,
                src_ip: str | None = None, detector: str | None = None) -> DataFrame:
    """O1: newest first (id breaks ties), filters before the page is cut."""
    if not 1 <= limit <= MAX_LIST_LIMIT:
        raise ValueError(f"limit must be in 1..{MAX_LIST_LIMIT}")
    if offset < 0:
        raise ValueError("offset must be >= 0")
    page = filter_alerts(alerts, severity, src_ip, detector).orderBy(F.desc("created_at"), F.asc("id"))
    return page.offset(offset).limit(limit) if offset else page.limit(limit)


def list_after(alerts: DataFrame, cursor: tuple | None = None, limit: int = 100, severity: str | None = None,
               src_ip: str | None = None, detector: str | None = None) -> DataFrame:
    """O1 by cursor: the page after the row ``cursor`` = (created_at, id) of the same order as :func:`list_alerts`.
    The bound on ``created_at`` reaches the scan, so rows of earlier pages are not sorted again."""
    if not 1 <= limit <= MAX_LIST_LIMIT:
        raise ValueError(f"limit must be in 1..{MAX_LIST_LIMIT}")
    rows = filter_alerts(alerts, severity, src_ip, detector)
    if cursor is not None:
        at, last = F.lit(cursor[0]).cast("timestamp_ntz"), F.lit(cursor[1])
        rows = rows.where(F.col("created_at") <= at)
        rows = rows.where((F.col("created_at") < at) | (F.col("id") > last))
    return rows.orderBy(F.desc("created_at"), F.asc("id")).limit(limit)


def get_alert(alerts: DataFrame, alert_id: str | Column) -> DataFrame:
    """The row with this id, or nothing."""
    v = alert_id if isinstance(alert_id, Column) else F.lit(alert_id)
    return alerts.where(F.col("id") == v)


def current_view(alerts: DataFrame, acks: DataFrame) -> DataFrame:
    """acknowledged = an ack exists for the id (acks are deduplicated first)."""
    a = acks.select("id").distinct().withColumn("_acked", F.lit(True))
    return (alerts.drop("acknowledged").join(a, "id", "left")
            .withColumn("acknowledged", F.coalesce(F.col("_acked"), F.lit(False))).drop("_acked"))


def unknown_acks(alerts: DataFrame, acks: DataFrame) -> DataFrame:
    """Acknowledgements naming no alert (the API answers 'not found' for these)."""
    return acks.select("id").distinct().join(alerts.select("id"), "id", "left_anti")


def stats_total(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count("id").alias("total"))


def stats_by(alerts: DataFrame, col: str) -> DataFrame:
    return alerts.groupBy(col).agg(F.count("id").alias("n"))


def top_sources(alerts: DataFrame, n: int = 10) -> DataFrame:
    """A4: most frequent sources (ties broken by address)."""
    return (alerts.groupBy("src_ip").agg(F.count("id").alias("n"))
            .orderBy(F.desc("n"), F.asc("src_ip")).limit(n))


def stats_grouping_sets(alerts: DataFrame) -> DataFrame:
    """A5 in one pass: GROUPING SETS ((), (severity), (detector), (src_ip)) -> (dim, key, n)."""
    g = alerts.groupingSets([[], ["severity"], ["detector"], ["src_ip"]], "severity", "detector", "src_ip")
    r = g.agg(F.count("id").alias("n"), F.grouping_id().alias("gid"))
    # grouping_id bits: severity=4, detector=2, src_ip=1 (1 = rolled up)
    dim = (F.when(F.col("gid") == 7, F.lit("total")).when(F.col("gid") == 3, F.lit("severity"))
           .when(F.col("gid") == 5, F.lit("detector")).otherwise(F.lit("src_ip")))
    key = F.coalesce(F.col("severity"), F.col("detector"), F.col("src_ip"), F.lit(""))
    return r.select(dim.alias("dim"), key.alias("key"), F.col("n"))


def stats(alerts: DataFrame, top_n: int = 10) -> DataFrame:
    """A5 nested: one row (total, by_severity map, by_detector map, top_src_ips list).

    Each partition keeps its ``KEPT`` largest counts of a dimension before the exchange (window group limit), so
    the one row is made from a bounded number of sources however many there are. Severities and detectors are
    fixed vocabularies, far fewer than ``KEPT``."""
    if not 1 <= top_n <= KEPT:
        raise ValueError(f"top_n must be in 1..{KEPT}")
    order = Window.partitionBy("dim").orderBy(F.desc("n"), F.asc("key"))
    rows = stats_grouping_sets(alerts).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= KEPT)

    def entries(dim: str) -> Column:
        return F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("dim") == dim, F.struct("key", "n")))))

    top = F.slice(F.array_sort(F.collect_list(F.when(F.col("dim") == "src_ip", F.struct("nth", "key", "n")))), 1, top_n)
    return rows.agg(
        F.max(F.when(F.col("dim") == "total", F.col("n"))).alias("total"),
        entries("severity").alias("by_severity"), entries("detector").alias("by_detector"),
        F.transform(top, lambda x: F.struct(x["key"].alias("src_ip"), x["n"].alias("n"))).alias("top_src_ips"),
    )


def severity_share(alerts: DataFrame) -> DataFrame:
    """P25: share of each severity, in the fixed order critical, high, medium, low;
    missing severities count 0; the denominator is max(1, total)."""
    spark = alerts.sparkSession
    order = list(reversed(SEVERITIES))
    sev = spark.createDataFrame([(s, i) for i, s in enumerate(order)], "severity string, pos int")
    counts = stats_by(alerts, "severity")
    total = F.greatest(F.lit(1), F.sum("n").over(_whole()))
    return (F.broadcast(sev).join(counts, "severity", "left")
            .withColumn("n", F.coalesce(F.col("n"), F.lit(0)).cast("long"))
            .select("pos", "severity", "n", (F.col("n") * 100.0 / total).alias("share_pct")))


def _whole():
    return Window.partitionBy(F.lit(0))  # 4 rows only


def notify_payloads(alerts: DataFrame, min_severity: str = "low") -> DataFrame:
    """Alerts at or above the floor and their webhook payload."""
    if min_severity not in SEVERITIES:
        raise ValueError(f"unknown severity {min_severity!r}")
    floor = SEVERITIES.index(min_severity)
    return alerts.where(severity_rank() >= floor).select(
        "id", F.to_json(F.struct("rule_id", "name", "severity", "description", "src_ip", "dst_ip")).alias("payload"))


def live_payloads(alerts: DataFrame) -> DataFrame:
    """The live detection event, one row per alert."""
    return alerts.select(
        "id", F.lit("detection").alias("type"),
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at"),
        "rule_id", "name", "detector", "severity", F.round("confidence", 4).alias("confidence"),
        "description", "src_ip", "dst_ip", "dst_port")


def latest(alerts: DataFrame, n: int = LIVE_BUFFER) -> DataFrame:
    """O2: the rolling newest-N buffer."""
    return alerts.orderBy(F.desc("created_at"), F.asc("id")).limit(n)


def endpoint(ip: str, port: str) -> Column:
    """``ip:port`` with ``-`` for port 0."""
    return F.concat(F.col(ip), F.lit(":"),
                    F.when(F.col(port) == 0, F.lit("-")).otherwise(F.col(port).cast("string")))


def formatted_rows(alerts: DataFrame) -> DataFrame:
    """The alert table as shown to an analyst."""
    return alerts.select(
        "id", "created_at", "severity", "name",
        endpoint("src_ip", "src_port").alias("source"), endpoint("dst_ip", "dst_port").alias("target"),
        F.format_string("%.0f%%", F.col("confidence") * 100).alias("confidence_pct"))


def feed_merge(live: DataFrame, persisted: DataFrame, compat: bool = False) -> DataFrame:
    """Live events first, then persisted alerts not already shown live, matched on
    (time, source, target, name). ``compat=True`` reproduces the original key, where the
    live source lacks the port so nothing ever matches."""
    src_live = F.col("src_ip") if compat else endpoint("src_ip", "src_port")
    live_k = live.select("id", "created_at", "name", src_live.alias("src"),
                         endpoint("dst_ip", "dst_port").alias("dst"), F.lit(0).alias("origin"))
    pers_k = persisted.select("id", "created_at", "name", endpoint("src_ip", "src_port").alias("src"),
                              endpoint("dst_ip", "dst_port").alias("dst"), F.lit(1).alias("origin"))
    keys = ["created_at", "src", "dst", "name"]
    rest = pers_k.join(live_k.select(*keys).distinct(), keys, "left_anti")
    return live_k.unionByName(rest)

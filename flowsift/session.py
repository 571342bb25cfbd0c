"""Session helpers: a local session for tests/bench, and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "flowsift") -> SparkSession:
    """Local session used by tests and the bench (a cluster brings its own)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting is provided and used as is. Only when it is unset
    (local tests) do we create a scratch folder of our own; on any other master that folder would be
    another one for each executor, so an unset setting is an error there.
    """
    ship_package(spark)
    cur = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not cur:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        cur = tempfile.mkdtemp(prefix="flowsift-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", cur)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(cur)
    return cur


def scratch_path(spark: SparkSession, name: str) -> str:
    """A table location under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    import uuid

    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def parquet_if_there(spark: SparkSession, path: str, schema=None):
    """The Parquet table at ``path``, or None where the path does not exist. Any other failure is raised."""
    from pyspark.errors import AnalysisException

    try:
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def materialize(df, name: str):
    """Cut lineage by writing ``df`` as a Parquet table in the shared checkpoint folder and
    reading it back: computed once, and re-readable by any executor after a loss."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``flowsift`` importable on every executor's Python workers (they unpickle the
    functions passed to applyInPandas / mapInPandas / state processors / the data source).

    The package is zipped once per application and handed to ``SparkContext.addPyFile``,
    which distributes it to all executors, including ones started later."""
    import zipfile
    from pathlib import Path

    import flowsift

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(flowsift.__file__).resolve().parent
    fd, zpath = tempfile.mkstemp(prefix="flowsift-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*")):
            if f.is_file() and "__pycache__" not in f.parts and f.suffix in (".py", ".yaml", ".yml"):
                z.write(f, str(f.relative_to(root.parent)))
    spark.sparkContext.addPyFile(zpath)
    _SHIPPED.add(app)

"""Column helpers and scratch tables shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.session import scratch_path, ship_package

#: Java form of the separators 0x20 and 0x09-0x0D.
SPACES = r"[\t-\r ]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipped(df: DataFrame) -> DataFrame:
    """``df``, once executors can import this package: to be called before a Python function for them is made."""
    ship_package(df.sparkSession)
    return df


def scratch(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a zstd Parquet table in the shared checkpoint folder and read back:
    cuts lineage, survives lost executors, and later stages never repeat the work above it."""
    spark = df.sparkSession
    ship_package(spark)
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def doc_key(id_col: Column, text: Column) -> list[Column]:
    """Key of a row that needs no row number: its id and two hashes of its text. Rows that agree
    in all three are copies of each other and are treated alike."""
    body = F.coalesce(text, F.lit("\0"))
    return [id_col.cast("long").alias("k_id"), F.xxhash64(body).alias("k_h1"), F.hash(body).alias("k_h2")]


KEY = ["k_id", "k_h1", "k_h2"]


def join_key(a: DataFrame, b: DataFrame, how: str = "left") -> DataFrame:
    """``a`` joined with ``b`` on the columns of :func:`doc_key`, null ids being equal."""
    b = b.withColumnsRenamed({k: f"__{k}" for k in KEY})
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in KEY]
    return a.join(b, same[0] & same[1] & same[2], how).drop(*[f"__{k}" for k in KEY])

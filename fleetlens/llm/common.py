"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.session import scratch_path

#: A word of every contract: a run of characters other than space and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of ``sf_dir``, through Spark's own reader only."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs its running tasks only, and row
    numbers or partition numbers in ``df`` stay what they were when written.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """As :func:`staged`, zstd-compressed, for wide binary columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with the number ``__row``, written once: the number of a row is
    stored with it and does not depend on how a later job splits the files."""
    return stored(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id written as text, modulo ``m``; a null id gives 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % m, F.lit(0))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

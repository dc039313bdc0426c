"""Schema probes and version fallbacks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has_column(df: DataFrame, name: str) -> bool:
    """Does the table have this column (case-insensitive, as SQL)."""
    return name.lower() in {c.lower() for c in df.columns}


def has_table(tables: Mapping, name: str) -> bool:
    """Is the table present in this server's schema."""
    return name in tables


def pick_column(df: DataFrame, candidates: Sequence[str], default=0) -> Column:
    """The first candidate column present. Only a fallback (not the
    first choice) is wrapped in ``coalesce(col, default)``; none present
    gives the default itself."""
    for i, c in enumerate(candidates):
        if has_column(df, c):
            return F.col(c) if i == 0 else F.coalesce(F.col(c), F.lit(default))
    return F.lit(default)


def empty_export(spark: SparkSession, columns: Sequence[str] | T.StructType) -> DataFrame:
    """Zero-row placeholder with a fixed header when the source table is
    absent. A ``name type`` column has that type, a plain name is text."""
    schema = columns if isinstance(columns, T.StructType) else T.StructType(
        [T.StructField(c.split(" ", 1)[0], T.DataType.fromDDL(c.split(" ", 1)[1]) if " " in c else T.StringType(), True)
         for c in columns])
    return spark.createDataFrame([], schema)

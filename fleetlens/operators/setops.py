"""Set operations over exports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def combine_servers(frames: Sequence[DataFrame]) -> DataFrame:
    """The same export from several servers as one frame. Columns are
    matched by name; a column one server lacks is NULL for its rows. Rows
    are then keyed by (source_server, id)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def row_rank(df: DataFrame, order: Sequence[str], hashed: Sequence[str] | None = None) -> Column:
    """What decides between rows of one key: the ``order`` columns, NULL first, then a
    hash of the row (of its columns ``hashed``), so that ties fall the same way in every run."""
    return F.struct(*[F.col(c) for c in order], F.xxhash64(*[F.col(c) for c in hashed or df.columns]).alias("__tie"))


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], hashed: Sequence[str] | None = None) -> DataFrame:
    """One row per key (NULL is a key like others): the one of the highest
    :func:`row_rank`. An aggregate that Spark combines map-side."""
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in others])
    agg = df.groupBy(*keys).agg(F.max_by(packed, row_rank(df, order, hashed)).alias("__row"))
    return agg.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in others]).select(*df.columns)


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str],
           order_col: str = "export_timestamp") -> DataFrame:
    """Insert or update by key, never delete: one row per key, the incoming one
    before the current one; of several incoming rows of a key the newest. A NULL
    key is a key like others. One aggregation over both sides, no join."""
    order = [order_col] if order_col in incoming.columns else []
    both = (incoming.withColumn("__incoming", F.lit(1))
            .unionByName(current.select(*incoming.columns).withColumn("__incoming", F.lit(0))))
    return newest_per_key(both, keys, ["__incoming", *order]).drop("__incoming")


def is_newer(incoming_ts: str | None, last_applied_ts: str | None) -> bool:
    """U4: is an export newer than the last one applied? Run stamps are
    fixed-width ``YYYYmmdd_HHMMSS`` strings, so text order is time order."""
    if incoming_ts is None:
        return False
    return last_applied_ts is None or incoming_ts > last_applied_ts


def upsert_if_newer(current: DataFrame, incoming: DataFrame, keys: Sequence[str],
                    incoming_ts: str, last_applied_ts: str | None) -> DataFrame:
    """U2 guarded by U4: an export already applied leaves the target as is."""
    return upsert(current, incoming, keys) if is_newer(incoming_ts, last_applied_ts) else current


def content_hash(cols: Sequence[str]):
    """NULL-safe content digest: each value is preceded by its length, so no
    text can look like a separator."""
    parts = []
    for c in cols:
        v = F.col(c).cast("string")
        parts.append(F.when(v.isNull(), F.lit("N")).otherwise(F.concat(F.length(v).cast("string"), F.lit(":"), v)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def diff(old: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """Per key, ``added`` / ``removed`` / ``changed`` / ``unchanged``
    between two snapshots; ``cols`` are compared (default: all non-key
    columns both sides have, without the run stamp)."""
    if cols is None:
        skip = set(keys) | {"export_timestamp", "report_timestamp"}
        cols = [c for c in new.columns if c in old.columns and c not in skip]
    o = old.select(*keys, content_hash(cols).alias("__old"))
    n = new.select(*keys, content_hash(cols).alias("__new"))
    j = o.join(n, list(keys), "full_outer")
    kind = (F.when(F.col("__old").isNull(), "added")
             .when(F.col("__new").isNull(), "removed")
             .when(F.col("__old") == F.col("__new"), "unchanged")
             .otherwise("changed"))
    return j.select(*keys, kind.alias("change"))

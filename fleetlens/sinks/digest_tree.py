"""Digest trees of snapshots (U3): what changed between two runs, without reading what did not.

    archive_index/digests-<export>/snapshot=<run_id>/rows/part=<p>   keys, leaf, digest per key
    archive_index/digests-<export>/snapshot=<run_id>/leaves          digest per leaf bucket
    archive_index/digests-<export>/snapshot=<run_id>/parts           digest per part
    archive_index/digests-<export>/snapshot=<run_id>/shape           numbers of buckets, schema of the rows; written last

A digest is free of order: the number of rows and the sums of two hashes of each. Keys
fall into ``parts`` x ``leaves`` buckets by hash. Two trees are compared from the top:
the digests of the parts, then those of the leaves of differing parts, then the
rows of differing leaves, which are joined by key. Rows are narrow (keys and digest) and
lie in a folder per part, sorted by leaf.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetlens.sinks.keyed_store import same_keys
from fleetlens.sources.tables import path_exists

PARTS = 16
LEAVES = 256
RUN_COLUMNS = ("export_timestamp", "report_timestamp")
DIGEST = ("n", "s1", "s2")


def tree_path(root: str, export: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/archive_index/digests-{export}/snapshot={run_id}"


def _summed(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.sum("n").alias("n"), *[F.sum(c).cast("decimal(38,0)").alias(c) for c in DIGEST[1:]])


def write_tree(df: DataFrame, path: str, keys: Sequence[str], cols: Sequence[str] | None = None,
               parts: int = PARTS, leaves: int = LEAVES) -> None:
    """Write the tree of ``df``. ``cols`` are compared (default: all but the keys and
    the run stamp). Rows that share a key, NULL included, are digested together."""
    cols = [c for c in df.columns if c not in keys and c not in RUN_COLUMNS] if cols is None else list(cols)
    # a NULL leaves a hash as it was, so each column's NULL flag is hashed too
    content = [x for c in cols for x in (F.col(c), F.col(c).isNull())]
    bucket = F.pmod(F.xxhash64(*keys), F.lit(parts * leaves)).cast("int")
    one = df.select(*keys, bucket.alias("leaf"), F.lit(1).cast("bigint").alias("n"),
                    F.xxhash64(F.lit("a"), *content).cast("decimal(38,0)").alias("s1"),
                    F.xxhash64(F.lit("b"), *content).cast("decimal(38,0)").alias("s2"))
    per_key = _summed(one, [*keys, "leaf"]).withColumn("part", F.floor(F.col("leaf") / leaves).cast("int"))
    (per_key.repartitionByRange("part", "leaf").sortWithinPartitions("part", "leaf")
     .write.mode("overwrite").partitionBy("part").parquet(f"{path}/rows"))
    spark = df.sparkSession
    rows = spark.read.schema(per_key.schema).parquet(f"{path}/rows")
    _summed(rows, ["part", "leaf"]).orderBy("part", "leaf").write.mode("overwrite").parquet(f"{path}/leaves")
    low = spark.read.schema(f"part int, leaf int, {_SUMS}").parquet(f"{path}/leaves")
    _summed(low, ["part"]).write.mode("overwrite").parquet(f"{path}/parts")
    shape = [(parts, leaves, per_key.drop("part").schema.json())]
    spark.createDataFrame(shape, _SHAPE).coalesce(1).write.mode("overwrite").json(f"{path}/shape")


_SUMS = "n bigint, s1 decimal(38,0), s2 decimal(38,0)"
_SHAPE = "parts int, leaves int, rows string"


def has_tree(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/shape/_SUCCESS")


def _differing(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Buckets whose digests differ or that one side lacks."""
    old = a.select(*by, F.struct(*DIGEST).alias("old"))
    new = b.select(*by, F.struct(*DIGEST).alias("new"))
    return old.join(new, list(by), "full_outer").filter(~F.col("old").eqNullSafe(F.col("new"))).select(*by)


def tree_diff(spark: SparkSession, old: str, new: str, keys: Sequence[str]) -> DataFrame:
    """Keys that were ``added``, ``removed`` or ``changed`` between two trees."""
    shapes = [spark.read.schema(_SHAPE).json(f"{p}/shape").first() for p in (old, new)]
    if shapes[0][:2] != shapes[1][:2]:
        raise ValueError(f"trees of different shape: {shapes[0][:2]} and {shapes[1][:2]}")
    tops = [spark.read.schema(f"part int, {_SUMS}").parquet(f"{p}/parts") for p in (old, new)]
    differ = sorted(r[0] for r in _differing(*tops, ["part"]).collect())  # at most ``parts`` rows
    low = [spark.read.schema(f"part int, leaf int, {_SUMS}").parquet(f"{p}/leaves").filter(F.col("part").isin(differ))
           for p in (old, new)]
    leaves = _differing(*low, ["part", "leaf"]).select("leaf")  # at most parts x leaves rows
    sides = []
    for p, shape in zip((old, new), shapes):
        schema = StructType.fromJson(json.loads(shape["rows"]))
        held = [f"{p}/rows/part={d}" for d in differ if path_exists(spark, f"{p}/rows/part={d}")]
        rows = spark.read.schema(schema).parquet(*held) if held else spark.createDataFrame([], schema)
        sides.append(rows.join(F.broadcast(leaves), "leaf", "left_semi").select(*keys, F.struct(*DIGEST).alias("digest")))
    a, b = sides
    j = a.join(b, same_keys(a, b, keys), "full_outer")
    change = (F.when(a["digest"].isNull(), "added").when(b["digest"].isNull(), "removed")
              .when(a["digest"] != b["digest"], "changed"))
    # a NULL key is equal to itself, so the side that has the row tells the key
    out = j.select(*[F.when(b["digest"].isNotNull(), b[k]).otherwise(a[k]).alias(k) for k in keys], change.alias("change"))
    return out.filter("change IS NOT NULL")


def write_run_tree(spark: SparkSession, root: str, export: str, run_id: str, keys: Sequence[str]) -> None:
    """The tree of a written export of a run."""
    from fleetlens.sinks.snapshot import snapshot_path

    write_tree(spark.read.parquet(snapshot_path(root, export, run_id)), tree_path(root, export, run_id), keys)


def run_changes(spark: SparkSession, root: str, export: str, old_run: str, new_run: str, keys: Sequence[str]) -> DataFrame:
    """Changes of an export between two runs, by their trees; runs without one are
    compared row by row."""
    from fleetlens.operators.setops import diff
    from fleetlens.sinks.snapshot import read_snapshot

    paths = [tree_path(root, export, r) for r in (old_run, new_run)]
    if all(has_tree(spark, p) for p in paths):
        return tree_diff(spark, *paths, keys)
    whole = [read_snapshot(spark, root, export, r) for r in (old_run, new_run)]
    return diff(*whole, keys).filter("change <> 'unchanged'")

"""A table kept by key in hash buckets, changed by merging batches.

    data/v=<n>.<batch>.<writer>/__bucket=<b>/part-*     rows of bucket b as of that version
    manifest/version=<n>.<batch>.<writer>/part-*.json    the folder of every bucket

A merge reads and rewrites only the buckets in which the batch wins: rows that
lose against what is stored (delivered again, or older) leave their bucket where
it is. Which win is found from keys and ranks alone; whole rows are dealt once, by
bucket, where their newest is found and written. A version is committed when its manifest is (``_SUCCESS``); the manifest
names a folder per bucket, old or new, so an unfinished merge is never seen and a
retried one rewrites its own folders. Two versions differ at most in the buckets
whose folders differ, which is what :func:`changed_rows` reads. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.operators.setops import newest_per_key, row_rank
from fleetlens.session import PACKED
from fleetlens.sources.tables import path_exists

BUCKET = "__bucket"
DEFAULT_BUCKETS = 64


def _children(spark: SparkSession, pattern: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [st.getPath().toString() for st in fs.globStatus(path) or []]


def versions(spark: SparkSession, target: str) -> list[tuple[int, str]]:
    """Committed versions in order: number and name (``<n>.<batch>.<writer>``)."""
    done = _children(spark, f"{target.rstrip('/')}/manifest/version=*/_SUCCESS")
    names = [p.rsplit("/", 2)[1].split("=", 1)[1] for p in done]
    return sorted((int(n.split(".")[0]), n) for n in names)


def read_manifest(spark: SparkSession, target: str, name: str) -> tuple[dict[int, str], int]:
    """Folder of every bucket of a version (one entry per bucket), and the number of buckets."""
    path = f"{target.rstrip('/')}/manifest/version={name}"
    rows = spark.read.schema("bucket int, folder string, buckets int").json(path).collect()
    return {r["bucket"]: r["folder"] for r in rows if r["bucket"] is not None}, rows[0]["buckets"]


def _read(spark: SparkSession, target: str, folders: Sequence[str], schema: T.StructType) -> DataFrame:
    """Rows of these bucket folders; none gives an empty frame."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{target.rstrip('/')}/data/{f}" for f in folders])


def stored_schema(spark: SparkSession, target: str, folders: dict[int, str]) -> T.StructType | None:
    some = next(iter(folders.values()), None)
    return spark.read.parquet(f"{target.rstrip('/')}/data/{some}").schema if some else None


def read_store(spark: SparkSession, target: str, schema: T.StructType | None = None,
               name: str | None = None) -> DataFrame | None:
    """All rows of a version (default: the newest); an empty target gives an empty
    frame of ``schema``, or None without one."""
    known = versions(spark, target)
    folders = read_manifest(spark, target, name or known[-1][1])[0] if known else {}
    found = stored_schema(spark, target, folders)
    if found is None:
        return None if schema is None else spark.createDataFrame([], schema)
    return _read(spark, target, list(folders.values()), found)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    """NULL-safe equality of the keys of two frames."""
    on = F.lit(True)
    for k in keys:
        on = on & a[k].eqNullSafe(b[k])
    return on


def merge(spark: SparkSession, target: str, batch: DataFrame, keys: Sequence[str], order: Sequence[str], mark: str,
          buckets: int = DEFAULT_BUCKETS, keep_versions: int = 2) -> list[int]:
    """Merge a batch: per key the row that ranks highest by ``order`` (NULL first,
    then a hash of the row) stays, whatever the order of delivery. ``mark`` names the
    batch; one that is committed is not applied again. The batch is read up to three times
and should be of stored rows. Returns the buckets rewritten."""
    base, known = target.rstrip("/"), versions(spark, target)
    if any(name.split(".", 1)[1] == mark for _, name in known):
        return []
    folders: dict[int, str] = {}
    if known:
        folders, buckets = read_manifest(spark, target, known[-1][1])  # the number of buckets is set by the first batch
    name = f"{known[-1][0] + 1 if known else 0}.{mark}"
    schema = stored_schema(spark, target, folders)
    if schema is not None:
        batch = batch.select(*schema.names)
    names, bucket = batch.columns, bucket_of(keys, buckets).alias(BUCKET)
    won = touched = [r[0] for r in batch.select(bucket).distinct().collect()]  # at most one row per bucket
    stored = [folders[b] for b in touched if b in folders]
    if stored:
        now = _read(spark, target, stored, schema)
        now = now.select(*keys, row_rank(now, order).alias("__now"))
        new = batch.select(*keys, row_rank(batch, order).alias("__new"))
        beats = new.join(now, same_keys(new, now, keys), "left").filter("__now IS NULL OR __new > __now")
        won = [r[0] for r in beats.select(*[new[k] for k in keys]).select(bucket).distinct().collect()]
    if won:
        rows = batch.filter(bucket_of(keys, buckets).isin(won))
        old = [folders[b] for b in won if b in folders]
        if old:
            rows = rows.unionByName(_read(spark, target, old, schema))
        dealt = rows.select(*names, bucket).repartition(len(won), BUCKET)
        rows = newest_per_key(dealt, [BUCKET, *keys], order, names)
        rows.write.mode("overwrite").options(**PACKED).partitionBy(BUCKET).parquet(f"{base}/data/v={name}")
        folders |= {b: f"v={name}/{BUCKET}={b}" for b in won}
    entries = [(b, f, buckets) for b, f in sorted(folders.items())] or [(None, None, buckets)]
    (spark.createDataFrame(entries, "bucket int, folder string, buckets int").coalesce(1)
     .write.mode("overwrite").json(f"{base}/manifest/version={name}"))
    if keep_versions > 0:
        sweep(spark, target, keep_versions)
    return sorted(won)


def sweep(spark: SparkSession, target: str, keep_versions: int) -> int:
    """Remove the folders that none of the newest ``keep_versions`` manifests names,
    and the manifests before those. Returns the number of folders removed."""
    from fleetlens.sinks.snapshot import delete_paths

    base, known = target.rstrip("/"), versions(spark, target)
    live: set[str] = set()
    for _, name in known[-keep_versions:]:
        live |= set(read_manifest(spark, target, name)[0].values())
    runs = {f.split("/")[0] for f in live}
    gone = [p for p in _children(spark, f"{base}/data/v=*") if p.rsplit("/", 1)[1] not in runs]
    gone += [p for p in _children(spark, f"{base}/data/v=*/{BUCKET}=*")
             if p.rsplit("/", 2)[1] in runs and "/".join(p.rsplit("/", 2)[1:]) not in live]
    n = delete_paths(spark, gone)
    delete_paths(spark, [f"{base}/manifest/version={name}" for _, name in known[:-keep_versions]])
    return n


def changed_rows(spark: SparkSession, target: str, keys: Sequence[str], old_name: str, new_name: str) -> DataFrame:
    """``old`` and ``new`` (structs, NULL where the version lacks the key) of every key
    whose row differs between two versions; only buckets with another folder are read."""
    before, _ = read_manifest(spark, target, old_name)
    after, _ = read_manifest(spark, target, new_name)
    differ = [b for b in after.keys() | before.keys() if before.get(b) != after.get(b)]
    schema = stored_schema(spark, target, after or before)
    a = _read(spark, target, [before[b] for b in differ if b in before], schema)
    b = _read(spark, target, [after[b] for b in differ if b in after], schema)
    a = a.select(*keys, F.struct(*schema.names).alias("old"))
    b = b.select(*keys, F.struct(*schema.names).alias("new"))
    j = a.join(b, same_keys(a, b, keys), "full_outer").select("old", "new")
    return j.filter(~F.col("old").eqNullSafe(F.col("new")))


def exists(spark: SparkSession, target: str) -> bool:
    return path_exists(spark, f"{target.rstrip('/')}/manifest") and bool(versions(spark, target))

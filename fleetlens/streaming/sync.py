"""Incremental sync of an export into a list kept by key, on Structured Streaming.

:func:`sync_published` streams the pointers of published runs: a micro-batch holds
the runs published since the last one, resolves them to their snapshot folders
and merges those rows into the target by key. Files of a run that failed or is
still being written are never read, since such a run has no pointer.
:func:`sync_stream` does the same for files that land in a folder.

The target is a :mod:`~fleetlens.sinks.keyed_store`: per key the newest row wins
(stamp, NULL first, then run, then a hash of the row), rows are inserted or
updated and never deleted, and a batch rewrites only the buckets it changes.
Delivering a run again changes nothing, and a retried batch rewrites its own folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.session import ensure_checkpoint_dir
from fleetlens.sinks import keyed_store

ORDER_COL = "export_timestamp"
RUN = "__run"
POINTER = "export_timestamp string"


def read_target(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The newest committed version of the target, or None when empty."""
    df = keyed_store.read_store(spark, target, schema)
    return None if df is None else df.drop(RUN)


def merge_batch(spark: SparkSession, batch: DataFrame, batch_id: int, target: str, keys: Sequence[str],
                order_col: str = ORDER_COL, keep_versions: int = 2, stream_id: str = "stream",
                buckets: int = keyed_store.DEFAULT_BUCKETS) -> list[int]:
    """foreachBatch body: newest row per key over target and batch. A batch that is
    committed is not applied again. Returns the buckets that were rewritten."""
    order = [order_col, RUN] if RUN in batch.columns else [order_col]
    return keyed_store.merge(spark, target, batch, keys, order, f"{batch_id}.{stream_id}", buckets, keep_versions)


def _stream_id(spark: SparkSession, ckpt: str) -> str:
    return spark.read.text(f"{ckpt.rstrip('/')}/metadata").select(F.get_json_object("value", "$.id")).first()[0]


def _checkpoint(spark: SparkSession, target: str, given: str | None) -> str:
    return given or f"{ensure_checkpoint_dir(spark).rstrip('/')}/fleetlens-sync/{target.strip('/').replace('/', '_')}"


def _run(stream: DataFrame, apply, ckpt: str) -> None:
    """All that arrived since the last call as one batch, then stop."""
    q = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", ckpt)
               .trigger(availableNow=True).start())
    q.awaitTermination()


def sync_stream(spark: SparkSession, src_dir: str, target: str, keys: Sequence[str],
                schema: T.StructType, checkpoint: str | None = None,
                order_col: str = ORDER_COL, buckets: int = keyed_store.DEFAULT_BUCKETS) -> None:
    """Merge every snapshot file that arrived in a landing folder since the last call
    (``availableNow``), so it runs from a schedule like the refresh. Files are
    found recursively and the run stamp is a column of every row."""
    ckpt = _checkpoint(spark, target, checkpoint)
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(src_dir)

    def apply(df, batch_id):
        merge_batch(spark, df, batch_id, target, keys, order_col, stream_id=_stream_id(spark, ckpt), buckets=buckets)
    _run(stream, apply, ckpt)


def sync_published(spark: SparkSession, root: str, export: str, target: str, keys: Sequence[str],
                   checkpoint: str | None = None, order_col: str = ORDER_COL,
                   buckets: int = keyed_store.DEFAULT_BUCKETS) -> None:
    """Merge the export of every run published under ``root`` since the last call. A
    run published late is picked up when it is; one that retention removed
    before it was read is passed over, as newer runs hold its rows."""
    from fleetlens.sinks.snapshot import read_snapshot, snapshot_path
    from fleetlens.sources.tables import path_exists

    ckpt = _checkpoint(spark, target, checkpoint)
    pointers = f"{root.rstrip('/')}/current/pointer"
    if not path_exists(spark, pointers):  # nothing was ever published
        return
    stream = spark.readStream.schema(POINTER).option("recursiveFileLookup", True).json(pointers)

    def apply(df, batch_id):
        runs = sorted(r[0] for r in df.select("export_timestamp").distinct().collect())  # a row per run
        frames = [read_snapshot(spark, root, export, r).withColumn(RUN, F.lit(r))
                  for r in runs if path_exists(spark, snapshot_path(root, export, r))]
        if frames:
            rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
            merge_batch(spark, rows, batch_id, target, keys, order_col, stream_id=_stream_id(spark, ckpt), buckets=buckets)
    _run(stream, apply, ckpt)

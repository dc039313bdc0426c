"""SparkSession construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session of this package relies on. AQE re-plans joins at
# run time (broadcast only when the measured side is small, split skewed
# partitions) and the UTC zone keeps timestamp literals unambiguous.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Sizing for a large cluster, applied by the refresh job only where the
# cluster configuration does not set them: many shuffle partitions that AQE
# coalesces to ~256 MB each, scan splits of 256 MB, and skewed partitions
# (5x the median and over 512 MB) split by the skew-join rule.
CLUSTER_DEFAULTS = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "fleetlens", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster, use the cluster's own
    session and call :func:`ensure_checkpoint_dir` on it instead."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    # checkpoints of page cuts are removed once nothing refers to them
    conf.setdefault("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    # local sessions keep catalog tables out of the working directory
    conf.setdefault("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="fleetlens-warehouse-"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir``, if any."""
    try:
        sc = spark.sparkContext
        value = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
        if value:
            return value
    except Exception:  # noqa: BLE001 - no SparkContext (remote session)
        pass
    try:
        return spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001
        return None


def is_local(spark: SparkSession) -> bool:
    """Does the session run in one JVM on this machine."""
    try:
        return spark.sparkContext.master.split("[")[0] == "local"
    except Exception:  # noqa: BLE001 - no SparkContext: a remote session
        return False


_LOCAL_CKPT: dict = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder. Local sessions without one get
    a private folder; on a cluster it must be configured, since a folder of
    one machine cannot be read by the others."""
    current = checkpoint_dir(spark)
    if current:
        return current
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = _LOCAL_CKPT.setdefault("dir", tempfile.mkdtemp(prefix="fleetlens-ckpt-"))
    try:
        spark.sparkContext.setCheckpointDir(local)
        return spark.sparkContext.getCheckpointDir() or local
    except Exception:  # noqa: BLE001 - remote session: keep the path for our own writes
        return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for jobs that have to
    write and read back (round trips, snapshots built inside a query)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/fleetlens-scratch/{name}-{uuid.uuid4().hex}"


#: Write options of Parquet that is kept: snapshots, staged sources, kept state. Pages of
#: version 2 store values without a dictionary as differences (sorted keys shrink most).
PACKED = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}

#: Write options of kept text: gzip that searches longer for a repeat and takes a short one for
#: chance (JSON 6 to 10 % smaller than by default, CSV 2 to 6 %; level 8 costs about twice the CPU).
PACKED_TEXT = {"compression": "gzip", "zlib.compress.level": "SEVEN", "zlib.compress.strategy": "FILTERED"}

#: Spark deletes the shuffle files of a query when the query ends, not when the driver's
#: garbage collector finds its plan.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropped_shuffles(spark: SparkSession):
    """For a series of jobs that each write their result: the disk holds the shuffle
    files of those that run, not of those that ended. Every frame in it is run once."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def _explicitly_set(spark: SparkSession, key: str) -> bool:
    try:
        return spark.sparkContext.getConf().contains(key) or spark.conf.get(key, None) is not None
    except Exception:  # noqa: BLE001
        return spark.conf.get(key, None) is not None


def apply_session_defaults(spark: SparkSession, cluster: bool = False) -> None:
    """Apply the runtime SQL settings on an existing session (those that can
    change after start-up); leaves settings the cluster already made alone.
    ``cluster`` adds the large-cluster sizing of :data:`CLUSTER_DEFAULTS`."""
    wanted = dict(SESSION_DEFAULTS)
    if cluster:
        for k, v in CLUSTER_DEFAULTS.items():
            if not _explicitly_set(spark, k):
                spark.conf.set(k, v)
    for k, v in wanted.items():
        if not k.startswith("spark.sql."):
            continue
        try:
            if spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
        except Exception:  # noqa: BLE001 - static confs cannot be changed
            pass
    os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")

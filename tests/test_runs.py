"""Runs, missing tables, text fidelity and the streaming target."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetlens.catalog import open_fleet
from fleetlens.context import RunContext
from fleetlens.plans.exports import EXPORTS, RUN_EXPORTS
from fleetlens.refresh_job import server_root
from fleetlens.session import scratch_path
from fleetlens.sinks import snapshot as snap
from fleetlens.sources import files
from fleetlens.sources.tables import jdbc_options, load_tables
from fleetlens.streaming.sync import merge_batch, read_target, sync_stream

CTX = RunContext(as_of=datetime(2024, 1, 30, 23, 58))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fleet(spark):
    return open_fleet(spark, SF)


def test_csv_keeps_every_text(spark):
    values = ["  x ", "\t", "a\r\nb", "a\nb", "", None, '"q", r', "\\", " ", ",", "NULL", "\u00e9", "''"]
    df = spark.createDataFrame([(i, v, i / 2) for i, v in enumerate(values)], "id int, text string, n double")
    path = scratch_path(spark, "csv-text")
    snap.write_csv(df, path)
    back = files.read_csv_export(spark, path, schema=df.schema)
    assert [r.text for r in back.orderBy("id").collect()] == values


def _source_folder(spark, fleet, leave_out):
    root = scratch_path(spark, "source")
    for n in snap.RUN_SOURCES:
        if n not in leave_out:
            fleet[n].write.parquet(f"{root}/{n}.parquet")
    return root


def test_run_without_a_table_is_published(spark, fleet):
    tables = load_tables(spark, _source_folder(spark, fleet, {"fuota_deployment"}), names=snap.RUN_SOURCES)
    assert "fuota_deployment" not in tables and "server" not in tables
    root = server_root(scratch_path(spark, "runs"), "lns/eu 1")
    ctx = RunContext(as_of=CTX.as_of, server_name="lns/eu 1")
    res = snap.run_exports(spark, tables, ctx, root, parallelism=4, stage=True, formats=("parquet", "csv", "json"))
    assert res.published, res.status.filter("NOT ok").collect()
    empty = snap.read_snapshot(spark, root, "fuota_deployments")
    full = EXPORTS["fuota_deployments"].build(fleet, ctx)
    assert empty.count() == 0 and dict(empty.dtypes) == dict(full.dtypes)
    assert [r.server_name for r in snap.read_snapshot(spark, root, "servers").collect()] == ["lns/eu 1"]
    # a published run is never written again
    with pytest.raises(ValueError, match="published"):
        snap.run_exports(spark, tables, ctx, root, ("tenants",))
    # every export is there in its file order
    for name in RUN_EXPORTS:
        keys = [(k, "asc") if isinstance(k, str) else k for k in EXPORTS[name].order]
        path = snap.snapshot_path(root, name, ctx.run_id)
        rows = [tuple(r[k] for k, _ in keys) for r in spark.read.parquet(path).withColumn(
            "__f", F.input_file_name()).withColumn("__i", F.monotonically_increasing_id()).orderBy("__f", "__i").collect()]
        for (a, b) in zip(rows, rows[1:]):
            for x, y, (_, way) in zip(a, b, keys):
                if x == y:
                    continue
                lo, hi = (x, y) if way == "asc" else (y, x)
                assert hi is None or (lo is not None and lo < hi), (name, a, b)
                break


def test_errors_keep_their_text_and_stop_publication(spark, fleet):
    root = scratch_path(spark, "runs")

    def broken():
        raise ValueError("first line\n" + "x" * 500)
    res = snap.run_exports(spark, fleet, CTX, root, ("tenants",), extra={"broken": broken}, with_codecs=False)
    assert not res.published and snap.current_run_id(spark, root) is None
    assert res.status.filter("NOT ok").first().error == "ValueError: first line\n" + "x" * 500


def test_storage_errors_are_not_read_as_empty(spark, monkeypatch):
    root = scratch_path(spark, "runs")
    snap.publish_current(spark, root, CTX)

    def fail(*a):
        raise OSError("storage")
    monkeypatch.setattr(snap, "published_runs", fail)
    with pytest.raises(OSError):
        snap.current_run_id(spark, root)
    with pytest.raises(FileNotFoundError):
        files.get_export(spark, root, "no_such_export", CTX.run_id)


def test_jdbc_tables_are_split():
    options = jdbc_options(snap.RUN_SOURCES, 16, "2016-01-01 00:00:00", "2024-01-30 00:00:00")
    assert "server" not in options
    for big in ("device", "device_keys", "gateway", "application", "device_queue_item"):
        assert options[big]["numPartitions"] == "16" and options[big]["partitionColumn"] == "created_at"
    assert "numPartitions" not in options["tenant"]


def test_stream_goes_on_after_a_new_checkpoint(spark):
    schema = "id int, v string, export_timestamp string"
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "target")

    def land(name, rows):
        spark.createDataFrame(rows, schema).write.parquet(f"{landing}/{name}")

    def rows():
        return sorted(tuple(r) for r in read_target(spark, target).collect())
    struct = spark.createDataFrame([], schema).schema
    first = scratch_path(spark, "ckpt")
    for i in range(3):
        land(f"a{i}", [(i, "old", f"2024010{i}")])
        sync_stream(spark, landing, target, ["id"], struct, first)
    land("b", [(1, "new", "20240201"), (9, "added", "20240201")])
    sync_stream(spark, landing, target, ["id"], struct, scratch_path(spark, "ckpt"))
    want = [(0, "old", "20240100"), (1, "new", "20240201"), (2, "old", "20240102"), (9, "added", "20240201")]
    assert rows() == want
    # a batch that was committed is not applied twice; another stream's batch of the same number is
    late = spark.createDataFrame([(9, "late", "20240301")], schema)
    merge_batch(spark, late, 5, target, ["id"], stream_id="s1")
    merge_batch(spark, late.withColumn("v", F.lit("again")), 5, target, ["id"], stream_id="s1")
    assert (9, "late", "20240301") in rows()
    merge_batch(spark, late.withColumn("export_timestamp", F.lit("20240302")), 5, target, ["id"], stream_id="s2")
    assert (9, "late", "20240302") in rows()

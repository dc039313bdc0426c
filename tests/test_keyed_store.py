"""The keyed store, the sync over published runs, and upsert: null stamps, ties, repeated and null keys."""

import os

from pyspark.sql import functions as F

from fleetlens.context import RunContext
from fleetlens.operators.setops import newest_per_key, upsert
from fleetlens.session import scratch_path
from fleetlens.sinks import keyed_store as ks
from fleetlens.sinks import snapshot as snap
from fleetlens.streaming.sync import merge_batch, read_target, sync_published, sync_stream

SCHEMA = "id int, v string, export_timestamp string"


def _df(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _size(path):
    path = path.removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_null_stamps_and_ties(spark):
    df = _df(spark, [(1, "a", None), (2, "a", None), (2, "b", "20240101"), (3, "x", "s"), (3, "y", "s"), (None, "n", "1"), (None, "m", "2")])
    got = _rows(newest_per_key(df, ["id"], ["export_timestamp"]))
    assert (1, "a", None) in got and (2, "b", "20240101") in got and (None, "m", "2") in got and len(got) == 4
    for n in (1, 2, 5):  # the tie of key 3 falls the same way however the rows are dealt
        assert _rows(newest_per_key(df.repartition(n), ["id"], ["export_timestamp"])) == got


def test_upsert_gives_one_row_per_key(spark):
    cur = _df(spark, [(1, "old", "1"), (None, "old", "1"), (7, "kept", "1")])
    inc = _df(spark, [(1, "late", "2"), (1, "new", "3"), (None, "new", None), (9, "added", None)])
    want = [(1, "new", "3"), (7, "kept", "1"), (9, "added", None), (None, "new", None)]
    assert _rows(upsert(cur, inc, ["id"])) == sorted(want, key=repr)
    assert "Join" not in upsert(cur, inc, ["id"])._jdf.queryExecution().toString()


def test_bytes_written_follow_the_touched_buckets(spark):
    target = scratch_path(spark, "store")
    first = spark.range(40_000).select(F.col("id").cast("int").alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("v"),
                                       F.lit("20240101").alias("export_timestamp"))
    assert len(ks.merge(spark, target, first, ["id"], ["export_timestamp"], "0.s", buckets=32)) == 32
    whole = _size(f"{target}/data")
    one = _df(spark, [(5, "changed", "20240102")])
    assert len(ks.merge(spark, target, one, ["id"], ["export_timestamp"], "1.s", keep_versions=5)) == 1
    name = ks.versions(spark, target)[-1][1]
    assert os.listdir(f"{target}/data/v={name}".removeprefix("file:")) != []
    assert 0 < _size(f"{target}/data/v={name}") < whole / 16
    # delivered again, delivered late, retried: no byte of data is written
    for mark, batch in (("2.s", one), ("3.s", _df(spark, [(5, "older", "20230101"), (6, "older", None)])), ("1.s", _df(spark, [(5, "x", "9")]))):
        assert ks.merge(spark, target, batch, ["id"], ["export_timestamp"], mark, keep_versions=5) == []
        assert not os.path.exists(f"{target}/data/v={ks.versions(spark, target)[-1][1]}".removeprefix("file:")) or mark == "1.s"
    df = ks.read_store(spark, target)
    assert df.count() == 40_000 and df.filter("id = 5").first()["v"] == "changed"


def test_changed_rows_read_differing_buckets_only(spark):
    target = scratch_path(spark, "store")
    rows = [(i, f"v{i}", "1") for i in range(500)] + [(None, "n", "1")]
    ks.merge(spark, target, _df(spark, rows), ["id"], ["export_timestamp"], "0.s", buckets=16)
    batch = [(3, "V3", "2"), (1000, "added", "2"), (None, "N", "2"), (4, "v4", "0")]
    changed = ks.merge(spark, target, _df(spark, batch), ["id"], ["export_timestamp"], "1.s", keep_versions=5)
    (_, a), (_, b) = ks.versions(spark, target)
    df = ks.changed_rows(spark, target, ["id"], a, b)
    got = {(r.old.v if r.old else None, r.new.v if r.new else None) for r in df.collect()}
    assert got == {("v3", "V3"), (None, "added"), ("n", "N")}
    read = {f.split("__bucket=")[1].split("/")[0] for f in df.inputFiles()}
    assert read == {str(x) for x in changed} and len(changed) <= 3


def test_sweep_keeps_what_manifests_name(spark):
    target = scratch_path(spark, "store")
    for i in range(6):
        ks.merge(spark, target, _df(spark, [(i, f"v{i}", "1"), (0, f"w{i}", str(i + 2))]), ["id"], ["export_timestamp"], f"{i}.s", buckets=8)
    assert len(ks.versions(spark, target)) == 2
    assert _rows(ks.read_store(spark, target)) == sorted([(0, "w5", "7")] + [(i, f"v{i}", "1") for i in range(1, 6)], key=repr)
    live = set()
    for _, name in ks.versions(spark, target):
        live |= set(ks.read_manifest(spark, target, name)[0].values())
    held = {"/".join(p.rsplit("/", 2)[1:]) for p in ks._children(spark, f"{target}/data/v=*/__bucket=*")}
    assert held == live


def test_empty_batches_and_targets(spark):
    target = scratch_path(spark, "store")
    assert read_target(spark, target) is None and read_target(spark, target, _df(spark, []).schema).count() == 0
    assert merge_batch(spark, _df(spark, []), 0, target, ["id"]) == []
    assert read_target(spark, target, _df(spark, []).schema).count() == 0
    merge_batch(spark, _df(spark, [(1, "a", None)]), 1, target, ["id"])
    merge_batch(spark, _df(spark, []), 2, target, ["id"])
    assert _rows(read_target(spark, target)) == [(1, "a", None)]


def _write(spark, root, day, rows, publish=True):
    c = RunContext(run_id=f"202401{day:02d}_000000")
    snap.write_snapshot(_df(spark, rows), root, "things", c.run_id, ordered=False)
    if publish:
        snap.publish_current(spark, root, c)
    return c


def test_only_published_runs_reach_the_target(spark):
    root, target, ckpt = (scratch_path(spark, n) for n in ("root", "target", "ckpt"))

    def sync():
        sync_published(spark, root, "things", target, ["id"], ckpt)
        return _rows(read_target(spark, target, _df(spark, []).schema))
    assert sync() == []                                         # no pointer folder yet
    _write(spark, root, 1, [(1, "a", "20240101"), (2, "b", "20240101")])
    assert sync() == [(1, "a", "20240101"), (2, "b", "20240101")]
    late = _write(spark, root, 2, [(1, "late", "20240102"), (3, "c", None)], publish=False)
    _write(spark, root, 3, [(2, "B", "20240103")])
    assert sync() == [(1, "a", "20240101"), (2, "B", "20240103")]   # run 2 is not published
    n = len(ks.versions(spark, target))
    assert sync() and len(ks.versions(spark, target)) == n       # nothing new: no batch
    snap.publish_current(spark, root, late)
    want = [(1, "late", "20240102"), (2, "B", "20240103"), (3, "c", None)]
    assert sync() == want
    gone = _write(spark, root, 4, [(8, "gone", "20240104")])
    snap.delete_paths(spark, [snap.snapshot_path(root, "things", gone.run_id)])
    assert sync() == want                                        # removed by retention before it was read
    sync_published(spark, root, "things", target, ["id"], scratch_path(spark, "ckpt"))
    assert _rows(read_target(spark, target)) == want             # all runs again, under a new checkpoint


def test_equal_stamps_are_decided_by_the_run(spark):
    root, target, ckpt = (scratch_path(spark, n) for n in ("root", "target", "ckpt"))
    _write(spark, root, 2, [(1, "second", "same")])
    sync_published(spark, root, "things", target, ["id"], ckpt)
    _write(spark, root, 1, [(1, "first", "same")])
    sync_published(spark, root, "things", target, ["id"], ckpt)
    assert _rows(read_target(spark, target)) == [(1, "second", "same")]


def test_landing_folder(spark):
    landing, target, ckpt = (scratch_path(spark, n) for n in ("landing", "target", "ckpt"))
    _df(spark, [(1, "a", None), (1, "b", "1")]).write.parquet(f"{landing}/x")
    sync_stream(spark, landing, target, ["id"], _df(spark, []).schema, ckpt, buckets=4)
    assert _rows(read_target(spark, target)) == [(1, "b", "1")]

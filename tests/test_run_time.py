"""What a run spends its time on: packing of texts, the search index, sorts."""

import glob
import zlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetlens.context import RunContext
from fleetlens.plans.exports import EXPORTS, Export, provenance, with_provenance
from fleetlens.session import scratch_path
from fleetlens.sinks import search_index
from fleetlens.sinks import snapshot as snap
from fleetlens.sources.fixtures import fleet_tables
from fleetlens.sources.tables import load_tables

RID = "20240130_235800"


@pytest.mark.parametrize("form", ["csv", "json"])
def test_kept_texts_are_packed_by_a_filtered_search(spark, form):
    """Short repeats are left to the code of the letters: as small, at less than half the search of level 8."""
    k = F.xxhash64("id")
    df = spark.range(20000, numPartitions=1).select(
        F.lower(F.hex(k)).alias("device_eui"), F.concat(F.lit("dev-"), F.abs(k % 900000).cast("string")).alias("device_name"),
        F.abs(k % 101).cast("double").alias("battery_level"), F.lit("lns-demo").alias("source_server"))
    text = {}
    for compression in ("none", "gzip"):
        path = scratch_path(spark, f"t-{form}")
        {"csv": snap.write_csv, "json": snap.write_json}[form](df, path, compression=compression)
        text[compression] = open(glob.glob(f"{path}/part-*".removeprefix("file:"))[0], "rb").read()
    assert zlib.decompress(text["gzip"], 31) == text["none"]

    def size(level, strategy):
        packed = zlib.compressobj(level, zlib.DEFLATED, 31, 8, strategy)
        return len(packed.compress(text["none"]) + packed.flush())
    want = size(7, zlib.Z_FILTERED)
    assert abs(len(text["gzip"]) - want) < 0.005 * want < 0.5 * abs(size(8, zlib.Z_DEFAULT_STRATEGY) - want)


VALUES = [("aabb", "Pump 1", "App"), ("aabb", "Pump 1", None), (None, None, "App"), ("", "x", ""), ("0000000000", "ÄÖü-ß", "app"),
          (None, None, None), ("ab", None, "Other"), ("aabb", "Pump 12", "App")]


def _indexed(spark, rows, files=1):
    root = scratch_path(spark, "t-index")
    df = spark.createDataFrame(rows, "device_eui string, device_name string, application_name string")
    snap.write_snapshot(df.coalesce(1) if files == 1 else df.repartition(files), root, "devices", RID, ordered=False)
    search_index.write_index(spark, root, RID)
    return root, search_index.index_path(root, RID)


@pytest.mark.parametrize("files", [1, 3])
def test_postings_hold_every_gram_of_every_row(spark, files):
    root, path = _indexed(spark, VALUES * 40, files)
    names = {r["number"]: r["file"] for r in spark.read.parquet(f"{path}/files").collect()}
    assert list(map(names.get, sorted(names))) == sorted(names.values()) and len(names) == files
    got = {}
    for r in spark.read.parquet(f"{path}/postings").collect():
        key = (r["field"], r["gram"])
        for i in range(64):
            if r["bits"] >> i & 1:
                assert (at := (names[r["number"]], r["block"] * 64 + i)) not in got.setdefault(key, set())
                got[key].add(at)
    want = {}
    for r in spark.read.parquet(snap.snapshot_path(root, "devices", RID)).select(
            "*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at")).collect():
        for c in search_index.FIELDS:
            v = r[c]
            if v is None:
                continue
            v = v.lower()
            cut = [v] if c == "application_name" or len(v) < 3 else [v[i:i + 3] for i in range(len(v) - 2)]
            for g in cut:
                want.setdefault((c, g), set()).add((r["file"], r["at"]))
    assert got == want
    sizes = {(r["field"], r["gram"]): r["n"] for r in spark.read.parquet(f"{path}/grams").collect()}
    assert sizes == {k: len(v) for k, v in want.items()}


def test_neighbours_that_share_a_gram_are_one_posting(spark):
    """Entries are combined by a hash of fixed width in the task that reads the rows, not sorted into lists."""
    _, path = _indexed(spark, [("aabb", "pump", None)] * 128)
    rows = spark.read.parquet(f"{path}/postings")
    assert rows.count() == 2 * 4 and {r["bits"] for r in rows.collect()} == {-1}  # of aab, abb, pum, ump: two blocks each


def test_an_index_of_no_devices(spark):
    _, path = _indexed(spark, [])
    assert spark.read.parquet(f"{path}/postings").count() == spark.read.parquet(f"{path}/grams").count() == 0


def test_a_sort_does_not_move_the_stamps_of_the_run(spark):
    ctx = RunContext(as_of=datetime(2024, 1, 30, 23, 58))
    base = spark.createDataFrame([("b", None), ("a", "y"), ("a", "x"), (None, "z")], "relay_device_name string, device_name string")
    base = base.withColumns({"relay_device_eui": F.lit("r"), "device_eui": F.lit("d")})
    df = with_provenance(base, ctx).select("export_timestamp", *base.columns, "source_server")
    moved, ordered = [], Export.ordered
    with pytest.MonkeyPatch.context() as m:
        m.setattr(Export, "ordered", lambda self, d: (moved.append(d.columns), ordered(self, d))[1])
        res = snap.run_exports(spark, {}, ctx, scratch_path(spark, "t-stamps"), (), with_codecs=False, publish=False,
                               extra={"relay_devices": lambda: df})
        assert res.status.first()["ok"] and moved == [df.columns]  # what others build may hold other values
        path = snap.write_snapshot(df, scratch_path(spark, "t-stamps"), "relay_devices", RID, stamps=provenance(ctx))
    assert moved[1] == base.columns
    written = spark.read.parquet(path)
    assert written.dtypes == df.dtypes
    assert [tuple(r) for r in written.coalesce(1).collect()] == [
        (RID, a, b, "r", "d", ctx.server_name) for a, b in (("a", "x"), ("a", "y"), ("b", None), (None, "z"))]


def test_a_run_sorts_its_exports_without_its_stamps(spark, monkeypatch):
    t = fleet_tables(load_tables(spark, "/root/testdata/sf0.001"))
    moved, ordered = {}, Export.ordered
    monkeypatch.setattr(Export, "ordered", lambda self, d: (moved.update({self.name: d.columns}), ordered(self, d))[1])
    ctx, names = RunContext(as_of=datetime(2024, 1, 30, 23, 58)), ("relay_devices", "device_summary", "tenants", "servers")
    root = scratch_path(spark, "t-stamped")
    assert snap.run_exports(spark, t, ctx, root, names, with_codecs=False).published
    assert not {"source_server", "export_timestamp", "report_timestamp"} & set(sum(moved.values(), []))
    for name in names:
        written, built = snap.read_snapshot(spark, root, name), EXPORTS[name].build(t, ctx)
        assert written.dtypes == built.dtypes
        assert sorted(map(repr, written.collect())) == sorted(map(repr, built.collect()))

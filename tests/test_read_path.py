"""Page directory, search index, Bloom filters and counts gathered while writing."""

import pytest
from pyspark.sql import functions as F

from fleetlens.context import RunContext
from fleetlens.operators.filters import search
from fleetlens.operators.ordering import page_after, page_rows
from fleetlens.plans import read_api
from fleetlens.plans.exports import EXPORTS
from fleetlens.session import scratch_path
from fleetlens.sinks import directory, search_index
from fleetlens.sinks import snapshot as snap

CTX = RunContext()
RID = CTX.run_id
NAMES = ["Pump", "pump 7", "Ärger", "x", "", "äb", None, "valve%_[a]", "Pump", "sensor-long-name-0123456789"]


def _devices(spark, n=3000):
    """Device rows with many equal names, null and short ones, over several files."""
    d = spark.range(n).select(
        F.lpad(F.conv(F.col("id").cast("string"), 10, 16), 16, "0").alias("device_eui"),
        F.element_at(F.array(*[F.lit(x).cast("string") for x in NAMES]), (F.col("id") % len(NAMES) + 1).cast("int")).alias("device_name"),
        F.when(F.col("id") % 3 != 0, F.concat(F.lit("App "), (F.col("id") % 5).cast("string"))).alias("application_name"),
        (F.col("id") * 7).alias("battery_level"))
    return d


@pytest.fixture(scope="module")
def run(spark):
    """A published run of one export of eight sorted files."""
    root = scratch_path(spark, "t-read")
    ordered = EXPORTS["devices"].ordered(_devices(spark).repartition(4))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    snap.write_snapshot(ordered, root, "devices", RID, ordered=False)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    directory.write_directory(spark, root, RID, {"devices": ordered.schema})
    search_index.write_index(spark, root, RID)
    snap.publish_current(spark, root, CTX)
    return root


def _rows(df):
    return [tuple(r) for r in df.collect()]


def _scan_rows(df):
    """Rows that the file scans of a frame let through, from their SQL metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


KEYS = [("device_name", "asc"), ("device_eui", "asc")]


def test_pages_by_number_read_two_files(spark, run):
    whole = snap.read_snapshot(spark, run, "devices", RID)
    assert len(whole.inputFiles()) >= 4
    for page, limit in ((1, 100), (2, 100), (5, 77), (30, 100), (31, 100), (10 ** 6, 3), ("2abc", "0")):
        info, rows = read_api.export_page(spark, run, "devices", page, limit)
        assert info.total == 3000
        assert _rows(rows) == _rows(page_rows(whole, KEYS, page, limit))
        assert len(rows.inputFiles()) <= 2
    with pytest.raises(ValueError):
        read_api.export_page(spark, run, "devices.json", -1, 10)
    with pytest.raises(FileNotFoundError):
        read_api.export_page(spark, run, "nothing")


def test_pages_behind_a_key(spark, run):
    """All rows once, across equal and null names, by keyset."""
    whole = snap.read_snapshot(spark, run, "devices", RID)
    seen, after = [], None
    while True:
        df = read_api.export_page_after(spark, run, "devices", after, 400)
        assert len(df.inputFiles()) <= 3
        got = df.collect()
        if not got:
            break
        assert _rows(df) == _rows(page_after(whole, KEYS, after, 400))
        seen += [r["device_eui"] for r in got]
        after = {c: got[-1][c] for c, _ in KEYS}
    assert len(seen) == len(set(seen)) == 3000
    before_all = read_api.export_page_after(spark, run, "devices", {"device_name": "", "device_eui": ""}, 5)
    assert _rows(before_all) == _rows(whole.orderBy("device_name", "device_eui").filter("device_name = ''").limit(5))


def test_runs_without_indexes_are_served_by_a_scan(spark):
    root = scratch_path(spark, "t-plain")
    snap.write_snapshot(_devices(spark, 300).orderBy(F.rand(1)), root, "devices", RID, ordered=False)
    snap.publish_current(spark, root, CTX)
    whole = snap.read_snapshot(spark, root, "devices", RID)
    info, rows = read_api.export_page(spark, root, "devices", 2, 40)
    assert info.total == 300 and _rows(rows) == _rows(page_rows(whole, KEYS, 2, 40))
    after = {"device_name": "Pump", "device_eui": "f"}
    assert _rows(read_api.export_page_after(spark, root, "devices", after, 9)) == _rows(page_after(whole, KEYS, after, 9))
    total, hits = read_api.search_devices(spark, root, "pump")
    assert (total, _rows(hits)) == (lambda n, d: (n, _rows(d)))(*search(whole, "pump", search_index.FIELDS, ["device_name", "device_eui"]))


@pytest.mark.parametrize("q", ["", None, "p", "B", "ä", "ÄB", "%", "_", "7", "um", "pum", "PUMP 7", "00f", "app 3", "a", "p 1",
                               "00000000000000ff", "sensor-long-name-012", "[a]", "nothing like this", "e_", "xyz"])
def test_search_by_the_index_equals_a_scan(spark, run, q):
    whole = snap.read_snapshot(spark, run, "devices", RID)
    for cap in (100, 7):
        want_total, want = search(whole, q, search_index.FIELDS, ["device_name", "device_eui"], cap)
        total, rows = read_api.search_devices(spark, run, q, cap)
        assert (total, _rows(rows)) == (want_total, _rows(want))


def test_search_reads_a_part_of_the_files(spark, run):
    total, rows = read_api.search_devices(spark, run, "0000000000ffffff")
    assert total == 0
    total, rows = read_api.search_devices(spark, run, "00000000000000ab")
    assert total == 1 and len(rows.inputFiles()) == 1
    path = search_index.index_path(run, RID)
    every = spark.read.parquet(f"{path}/postings")
    one = every.filter("field = 'device_eui' AND gram = 'ab0'")
    assert _scan_rows(one) < every.count() / 2


def test_bloom_filters_and_sorted_groups(spark):
    """An absent key opens no row group, a key a few of many."""
    path = scratch_path(spark, "t-bloom")
    df = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("device_eui"), F.col("id").alias("n"))
    df.repartition(1).write.options(**snap.key_options(["device_eui"]), **{"parquet.block.size": str(1 << 20)}).parquet(path)
    table = spark.read.parquet(path)
    missing = table.filter(F.col("device_eui") == "0" * 63 + "g")
    absent = table.filter(F.col("device_eui") == F.sha2(F.lit("no such id"), 256))
    one = table.filter(F.col("device_eui") == F.sha2(F.lit("777"), 256))
    assert _scan_rows(missing) == 0 and _scan_rows(absent) <= 40_000
    assert [r["n"] for r in one.collect()] == [777] and _scan_rows(one) <= 40_000
    plain = scratch_path(spark, "t-plain")
    df.repartition(1).write.options(**{"parquet.block.size": str(1 << 20)}).parquet(plain)
    without = spark.read.parquet(plain).filter(F.col("device_eui") == F.sha2(F.lit("777"), 256))
    assert _scan_rows(without) > 2 * _scan_rows(one)


def test_counts_are_gathered_by_the_write(spark):
    from fleetlens.catalog import open_fleet
    t = open_fleet(spark, "/root/testdata/sf0.001")
    root = scratch_path(spark, "t-gather")

    def bad():
        raise RuntimeError("source down")
    empty = spark.createDataFrame([], "a int, b string")
    res = snap.run_exports(spark, t, CTX, root, ("tenants", "devices"), extra={"empty_one": lambda: empty, "bad": bad},
                           parallelism=2, indexes=("pages", "search"))
    status = {r["export_name"]: (r["ok"], r["records"]) for r in res.status.collect()}
    assert status["empty_one"] == (True, 0) and status["bad"] == (False, None) and not res.published
    m = {r["export_name"]: r for r in snap.run_manifest(spark, root, RID).collect()}
    assert set(m) == {"tenants", "devices", "empty_one", snap.CODECS}
    written = snap.read_snapshot(spark, root, "devices", RID)
    d = m["devices"]
    assert d["records"] == written.count() == status["devices"][1]
    assert (d["first_key"], d["last_key"]) == tuple(written.agg(F.min("device_eui"), F.max("device_eui")).first())
    nulls = {c: written.filter(F.col(c).isNull()).count() for c in ("app_key", "battery_level", "device_eui")}
    assert {c: (d["null_counts"] or {}).get(c, 0) for c in nulls} == nulls
    assert m["empty_one"]["records"] == 0 and m["empty_one"]["first_key"] is None


def test_observed_writes_scan_once(spark):
    """The counts come from the job that writes: no further job reads the rows."""
    df = _devices(spark, 50)
    got = snap.Gathered("things", "device_eui")
    group = "gathered-once"
    spark.sparkContext.setJobGroup(group, "write")
    snap.write_snapshot(df, scratch_path(spark, "t-once"), "things", RID, ordered=False, gathered=got)
    entry = got.entry()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("", "")
    assert entry["records"] == 50 and entry["null_counts"] == {"device_name": 5, "application_name": 17} and len(jobs) == 1


def test_a_failing_index_keeps_the_run_unpublished(spark, monkeypatch):
    from fleetlens.catalog import open_fleet
    t = open_fleet(spark, "/root/testdata/sf0.001")
    root = scratch_path(spark, "t-index-fails")

    def broken(*a):
        raise RuntimeError("no space")
    monkeypatch.setattr(directory, "write_directory", broken)
    res = snap.run_exports(spark, t, CTX, root, ("tenants",), with_codecs=False)
    assert not res.published and res.status.filter("NOT ok").first()["export_name"] == "index pages"


def test_retention_removes_indexes_and_manifests(spark):
    from datetime import datetime

    from fleetlens.catalog import open_fleet
    t = open_fleet(spark, "/root/testdata/sf0.001")
    root = scratch_path(spark, "t-retain")
    runs = [RunContext(as_of=datetime(2024, 1, d, 12)) for d in (1, 2)]
    for c in runs:
        snap.run_exports(spark, t, c, root, ("tenants", "devices"), with_codecs=False, indexes=("pages", "search"))
    snap.refresh(spark, t, RunContext(as_of=datetime(2024, 1, 3, 12)), root, keep=2, formats=("parquet",))
    left = {p.rsplit("=", 1)[1] for p in snap.glob_paths(spark, f"{root}/archive_index/*/snapshot=*")}
    assert left == {"20240102_120000", "20240103_120000"}
    assert not snap.path_exists(spark, snap.manifest_path(root, runs[0].run_id))
    assert snap.path_exists(spark, snap.manifest_path(root, runs[1].run_id))

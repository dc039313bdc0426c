"""What queries over written files leave on disk and move: sources derived once, packed text, no shuffles of ended jobs."""

import glob
import time
import zlib
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fleetlens.context import RunContext
from fleetlens.plans import lifecycle, views
from fleetlens.plans.exports import EXPORTS, LARGE_EXPORTS, RUN_EXPORTS, device_lookups
from fleetlens.session import SHUFFLE_CLEANUP, scratch_path
from fleetlens.sinks import keyed_store, search_index
from fleetlens.sinks import snapshot as snap
from fleetlens.sources.fixtures import fleet_tables
from fleetlens.sources.tables import LazyTables

CTX = RunContext(as_of=datetime(2024, 1, 30, 23, 58))
N = 60


def _driver_tables(spark):
    """Driver tables of a small fleet; some keys come twice, some values are NULL."""
    at = F.timestamp_add("DAY", F.col("id").cast("int"), F.lit("2001-05-01 00:00:00").cast("timestamp_ntz"))
    k = F.col("id")
    n = spark.range(N)
    t = lambda *c: F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in c])
    s = k.cast("string")
    return {
        "region": spark.range(2).select(k.alias("r_regionkey"), t("R", s).alias("r_name")),
        "nation": spark.range(25).select(k.cast("int").alias("n_nationkey"), t("N", s).alias("n_name"), (k % 2).alias("n_regionkey")),
        "customer": n.select(k.alias("c_custkey"), (k % 25).cast("int").alias("c_nationkey"), t("C#", s).alias("c_name"), F.lit("m").alias("c_mktsegment")),
        "supplier": spark.range(9).select(k.alias("s_suppkey"), t("S#", s).alias("s_name"), (k % 25).cast("int").alias("s_nationkey")),
        "part": spark.range(30).select(k.alias("p_partkey"), t("P", s).alias("p_name"), F.lit("B").alias("p_brand"), F.lit("t").alias("p_type"), (k % 50).cast("int").alias("p_size")),
        "orders": n.unionByName(spark.range(2)).select(
            k.alias("o_orderkey"), (k % 40).alias("o_custkey"), F.element_at(F.array(F.lit("F"), F.lit("O"), F.lit("P")), (k % 3 + 1).cast("int")).alias("o_orderstatus"),
            at.alias("o_orderdate"), F.when(k % 4 == 0, "5-LOW").when(k % 4 == 1, "4-NOT SPECIFIED").when(k % 4 == 2, "1-URGENT").alias("o_orderpriority")),
        "lineitem": spark.range(4 * N).select((k % N).alias("l_orderkey"), (k % 30).alias("l_partkey"), (k % 9).alias("l_suppkey"), at.alias("l_shipdate")),
        "events": spark.range(2 * N).select(k.alias("event_id"), (k % N).alias("user_id"), at.alias("ts"),
                                            F.when(k % 2 == 0, "click").otherwise("error").alias("event_type"), F.lit("{}").alias("props")),
        "documents": spark.range(20).select(k.alias("doc_id"), F.when(k % 5 != 0, t("decode ", s)).alias("text")),
    }


class Counted(LazyTables):
    """Tables that count how often each is asked for."""

    def __init__(self, tables):
        super().__init__({n: (lambda n=n: tables[n]) for n in tables})
        self.asked = {}

    def __getitem__(self, name):
        self.asked[name] = self.asked.get(name, 0) + 1
        return super().__getitem__(name)


@pytest.fixture(scope="module")
def fleet(spark):
    return fleet_tables(_driver_tables(spark))


def _rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_two_runs_read_the_sources_once_and_pack_their_text(spark, fleet):
    t = Counted(fleet)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    root = lifecycle.two_runs(t, CTX)
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before  # holds for the jobs of the run alone
    assert t.asked["device"] == t.asked["multicast_group_device"] == t.asked["relay_device"] == 1
    at = root.removeprefix("file:")
    assert not glob.glob(f"{at}/staging/*")  # the copies of the sources go when the runs are written
    assert all(f.endswith(".zstd.parquet") for f in glob.glob(f"{at}/archive/*/snapshot=*/part-*.parquet"))
    for form in ("csv", "json"):
        files = glob.glob(f"{at}/archive_{form}/*/snapshot={CTX.run_id}/part-*")
        assert len({f.split("/")[-3] for f in files}) == len(RUN_EXPORTS) and all(f.endswith(f".{form}.gz") for f in files)
    for c in (lifecycle.previous_run(CTX), CTX):
        for name in ("devices", "relay_devices", "device_summary", "users"):
            assert _rows(snap.read_snapshot(spark, root, name, c.run_id)) == _rows(EXPORTS[name].build(fleet, c)), name
    counts = {r.export_name: r.records for r in lifecycle.run_csv(t, CTX).collect()}
    assert counts == {r.export_name: r.records for r in lifecycle.run_json(t, CTX).collect()}
    assert counts["devices"] == EXPORTS["devices"].build(fleet, CTX).count()


def test_devices_from_given_lookups(spark, fleet):
    given = lifecycle.written_once(fleet, scratch_path(spark, "t-lookups"), device_lookups=device_lookups(fleet))
    built = EXPORTS["devices"].build(given, CTX)
    assert built.dtypes == EXPORTS["devices"].build(fleet, CTX).dtypes
    assert _rows(built) == _rows(EXPORTS["devices"].build(fleet, CTX))
    assert "lineitem" not in built._jdf.queryExecution().optimizedPlan().toString() and "Join" not in built._jdf.queryExecution().optimizedPlan().toString()


def test_kept_counters_store_only_what_they_are_made_of(spark, fleet, monkeypatch):
    seen, merge = [], keyed_store.merge
    monkeypatch.setattr(keyed_store, "merge", lambda s, target, batch, *a, **b: (seen.append(batch.columns), merge(s, target, batch, *a, **b))[1])
    kept = lifecycle.kept_device_summary(fleet, CTX)
    assert len(seen) == lifecycle.KEPT_RUNS and not {"name", "description", "dev_addr"} & set(sum(seen, []))
    one = {n: (lambda n=n: fleet[n].dropDuplicates(["dev_eui"]) if n == "device" else fleet[n]) for n in fleet}
    assert _rows(kept) == _rows(EXPORTS["device_summary"].build(LazyTables(one), CTX))


def test_a_merge_deals_whole_rows_once(spark, monkeypatch):
    """No copy of the batch is kept beside the store; ties and null keys fall as ranked."""
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", lambda *a, **b: pytest.fail("the batch is written twice"))
    target = scratch_path(spark, "t-merge")
    schema = "k long, at string, v long"
    batches = [[(1, "b", 1), (1, "a", 2), (None, "a", 3), (2, None, 4)], [(1, "a", 5), (2, "a", 6), (3, "a", 7), (None, "b", 8)]]
    for i, rows in enumerate(batches):
        assert keyed_store.merge(spark, target, spark.createDataFrame(rows, schema), ["k"], ["at"], f"b{i}", buckets=4)
    assert _rows(keyed_store.read_store(spark, target)) == sorted(map(repr, [(1, "b", 1), (2, "a", 6), (3, "a", 7), (None, "b", 8)]))
    again = spark.createDataFrame(batches[0], schema)
    assert keyed_store.merge(spark, target, again, ["k"], ["at"], "b2", buckets=4) == []


def test_orphans_are_counted_by_numbers_not_names(spark, fleet):
    report = views.orphan_report(fleet, CTX)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Aggregate [ref" in line and "child_table" in line]
    got = {(r.child_table, r.foreign_key): r.orphan_rows for r in report.collect()}
    assert len(got) == len(views.FOREIGN_KEYS)
    for child, fk, parent, pk in views.FOREIGN_KEYS:
        known = {r[0] for r in fleet[parent].select(pk).collect()}
        assert got[child, fk] == sum(r[0] is not None and r[0] not in known for r in fleet[child].select(fk).collect()), (child, fk)


def test_a_run_keeps_the_copies_of_large_exports_no_longer_than_needed(spark, fleet, monkeypatch):
    """Rows of the large exports are derived and looked up once for both runs, from sources that are not
    copied; today's run drops those of an export before its texts are written, and one is sorted at a time."""
    t = Counted(fleet)
    held, sorting, together, staged = {}, set(), [], []
    write, text, stage = snap.write_snapshot, snap.write_json, snap.stage_sources

    def writes(df, root, export, *a, **b):
        if export in LARGE_EXPORTS:
            sorting.add(export)
            together.append(len(sorting))
            time.sleep(0.5)
        try:
            return write(df, root, export, *a, **b)
        finally:
            sorting.discard(export)

    def texts(df, path, *a, **b):
        held[path.split("/")[-2]] = {f.split("/")[-1] for f in glob.glob(f"{path.split('/archive_json')[0]}/staging/*/*".removeprefix("file:"))}
        return text(df, path, *a, **b)

    monkeypatch.setattr(snap, "write_snapshot", writes)
    monkeypatch.setattr(snap, "write_json", texts)
    monkeypatch.setattr(snap, "stage_sources", lambda *a, **b: (staged.extend(a[4]), stage(*a, **b))[1])
    root = lifecycle.two_runs(t, CTX)
    assert snap.current_run_id(spark, root) == CTX.run_id
    large = {n: known.table for n, known in LARGE_EXPORTS.items()}
    for name, known in LARGE_EXPORTS.items():
        assert t.asked[known.source] == 1 and known.source not in staged, name
        assert known.table not in held[name], name
    order = list(large)
    for i, name in enumerate(order):  # those of the exports before it are gone, those behind it are kept
        assert held[name] & set(large.values()) == {large[n] for n in order[i + 1:]}, name
    assert len(together) == 2 * len(large) and set(together) == {1}
    for c in (lifecycle.previous_run(CTX), CTX):
        for name in LARGE_EXPORTS:
            written, built = snap.read_snapshot(spark, root, name, c.run_id), EXPORTS[name].build(fleet, c)
            assert written.dtypes == built.dtypes and _rows(written) == _rows(built), name


def test_an_index_that_fails_keeps_the_run_from_being_published(spark, fleet, monkeypatch):
    monkeypatch.setattr(search_index, "write_index", lambda *a: 1 / 0)
    res = snap.run_exports(spark, fleet, CTX, scratch_path(spark, "t-index"), ("tenants", "devices"), with_codecs=False,
                           indexes=("pages", "search"), formats=("parquet", "json"))
    assert not res.published
    assert {r.export_name: r.ok for r in res.status.collect()} == {"tenants": True, "devices": True, "index search": False}


def test_kept_files_have_pages_of_version_two(spark):
    path = snap.write_snapshot(spark.range(100).select(F.col("id").cast("string").alias("device_eui")), scratch_path(spark, "t-pages"),
                               "devices", "r", ordered=False).removeprefix("file:")
    group = pq.ParquetFile(glob.glob(f"{path}/part-*")[0]).metadata.row_group(0)
    assert "DELTA_BYTE_ARRAY" in group.column(0).encodings  # distinct values, as differences


def test_todays_run_ends_with_nothing_beside_what_it_keeps(spark, fleet, monkeypatch):
    """Staged tables go when all that is made from them is written, not when the run ends, and no large
    export is sorted while the disk holds the CSV form of another."""
    left, csv = [], []
    write, publish = snap.write_snapshot, snap.publish_current

    def found(root, pattern):
        return {f.split("/")[-1] for f in glob.glob(f"{root}/{pattern}".removeprefix("file:"))}

    def writes(df, root, export, run_id, **b):
        if export in LARGE_EXPORTS:
            csv.append(found(root, "archive_csv/*") & set(LARGE_EXPORTS))
        return write(df, root, export, run_id, **b)

    def publishes(s, root, ctx):
        left.append(found(root, "staging/*/*"))
        return publish(s, root, ctx)

    monkeypatch.setattr(snap, "write_snapshot", writes)
    monkeypatch.setattr(snap, "publish_current", publishes)
    root = lifecycle.two_runs(LazyTables({n: (lambda n=n: fleet[n]) for n in fleet}), CTX)
    assert {"device", "tenant", "device_lookups"} <= left[0] and left[1] == set()
    assert len(csv) == 2 * len(LARGE_EXPORTS) and not set().union(*csv)
    assert found(root, "archive_csv/*") == found(root, "archive_json/*") == set(RUN_EXPORTS)
    for c in (lifecycle.previous_run(CTX), CTX):
        counts = {r.export_name: r.records for r in snap.run_manifest(spark, root, c.run_id).collect()}
        assert set(counts) == {*RUN_EXPORTS, snap.CODECS}


def test_a_failed_csv_form_keeps_the_run_from_being_published(spark, fleet, monkeypatch):
    monkeypatch.setattr(snap, "write_csv", lambda *a, **b: 1 / 0)
    root = scratch_path(spark, "t-csv")
    res = snap.run_exports(spark, fleet, CTX, root, ("tenants", "devices"), parallelism=2, formats=("parquet", "csv", "json"))
    got = {r.export_name: (r.ok, r.error) for r in res.status.collect()}
    assert not res.published and set(got) == {"tenants", "devices", snap.CODECS} and got[snap.CODECS] == (True, None)
    assert got["tenants"] == got["devices"] == (False, "ZeroDivisionError: division by zero")
    assert {r.export_name for r in snap.run_manifest(spark, root, CTX.run_id).collect()} == {snap.CODECS}


def test_kept_texts_are_searched_longer_for_repeats(spark):
    k = F.col("id") * 7919 % 150000
    df = spark.range(20000, numPartitions=1).select(
        F.lower(F.lpad(F.hex(k), 16, "0")).alias("device_eui"), F.concat(F.lit("dev-"), k.cast("string")).alias("device_name"),
        F.date_add(F.lit("1992-01-01").cast("date"), (F.xxhash64(k) % 2400).cast("int")).cast("timestamp_ntz").alias("created_at"),
        F.lit("lns-demo").alias("source_server"), F.lit("20240130_235800").alias("export_timestamp"))
    for form, write in (("csv", snap.write_csv), ("json", snap.write_json)):
        text = {}
        for compression in ("none", "gzip"):
            path = scratch_path(spark, f"t-{form}")
            write(df, path, compression=compression)
            text[compression] = open(glob.glob(f"{path}/part-*".removeprefix("file:"))[0], "rb").read()
        assert zlib.decompress(text["gzip"], 31) == text["none"]
        assert len(text["gzip"]) < 0.99 * len(zlib.compress(text["none"], 6)), form

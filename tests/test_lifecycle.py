"""Sinks, snapshots, upsert, diff and the streaming sync on small frames."""

from datetime import datetime


from fleetlens.context import RunContext
from fleetlens.operators.setops import diff, is_newer, upsert
from fleetlens.session import scratch_path
from fleetlens.sinks import snapshot as snap
from fleetlens.sources import files
from fleetlens.sources.schema import empty_export, has_column, pick_column
from fleetlens.streaming.sync import read_target, sync_stream


def test_csv_roundtrip_keeps_awkward_text(spark):
    rows = [(1, 'line1\nline2', 'say "hi", ok'), (2, None, ""), (3, "x", None)]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    path = scratch_path(spark, "t-csv")
    snap.write_csv(df, path)
    back = {r.id: (r.a, r.b) for r in files.read_csv_export(spark, path, schema=df.schema).collect()}
    assert back[1] == ('line1\nline2', 'say "hi", ok')
    assert back[2][0] is None and back[3][1] is None


def test_stringly_json(spark):
    df = spark.createDataFrame([(True, None, 3, datetime(2024, 1, 1, 1, 2, 3))],
                               "b boolean, s string, n int, t timestamp_ntz")
    path = scratch_path(spark, "t-json")
    snap.write_json(df, path, stringly_typed=True)
    r = files.read_json_export(spark, path, files.all_string(df.columns)).first()
    assert (r.b, r.s, r.n, r.t) == ("t", "", "3", "2024-01-01 01:02:03")


def test_codec_file_form_one_file_per_codec(spark):
    tables = {
        "device": spark.createDataFrame([(b"\x01", 1), (b"\x02", 2)], "dev_eui binary, device_profile_id long"),
        "device_profile": spark.createDataFrame(
            [(1, "A b/c", "a\nb"), (2, "Z", "   "), (3, "unused", "x")],
            "id long, name string, payload_codec_script string"),
    }
    path = scratch_path(spark, "t-codecs")
    snap.write_codec_files(tables, path)
    listing = files.list_codec_files(spark, path).collect()
    assert [(r.codec_file, r.size_bytes) for r in listing] == [("A_bc_1.js", 4)]
    content = files.read_codec_files(spark, path).collect()
    assert [(r.codec_file, r.script) for r in content] == [("A_bc_1.js", "a\nb\n")]
    ds = scratch_path(spark, "t-codec-ds")
    snap.write_codecs(tables, ds)
    assert files.get_codec(spark, ds, "A_bc_1").first().script == "a\nb"
    assert files.get_codec(spark, ds, "missing").count() == 0


def test_publish_current_and_failed_run(spark):
    root = scratch_path(spark, "t-runs")
    t = {"tenant": spark.createDataFrame([(1, "t1")], "id int, name string")}
    ok = lambda: t["tenant"]
    c1 = RunContext(as_of=datetime(2024, 1, 1))
    c2 = RunContext(as_of=datetime(2024, 1, 2))
    r1 = snap.run_exports(spark, t, c1, root, (), extra={"x": ok}, with_codecs=False)
    assert r1.published and snap.current_run_id(spark, root) == c1.run_id

    def bad():
        raise RuntimeError("source down")
    r2 = snap.run_exports(spark, t, c2, root, (), extra={"x": ok, "y": bad}, with_codecs=False)
    status = {r.export_name: r.ok for r in r2.status.collect()}
    assert status == {"x": True, "y": False} and not r2.published
    # the failed run did not replace the current one
    assert snap.current_run_id(spark, root) == c1.run_id
    assert snap.read_snapshot(spark, root, "x").count() == 1


def test_retention_keeps_newest(spark):
    snaps = spark.createDataFrame([(f"2024010{i}_000000",) for i in range(1, 10)], "snapshot string")
    out = {r.snapshot: r.keep for r in snap.expired_snapshots(snaps, keep=3).collect()}
    assert [k for k, v in sorted(out.items()) if v] == ["20240107_000000", "20240108_000000", "20240109_000000"]


def test_metadata_fallback(spark):
    r = files.read_metadata(spark, scratch_path(spark, "nothing-here")).first()
    assert r.server_name == "unknown" and r.export_date == "unknown"


def test_upsert_and_diff(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    inc = spark.createDataFrame([(2, "B"), (3, "c"), (4, "d")], "k int, v string")
    merged = {r.k: r.v for r in upsert(cur, inc, ["k"]).collect()}
    assert merged == {1: "a", 2: "B", 3: "c", 4: "d"}     # never deletes key 1
    again = {r.k: r.v for r in upsert(upsert(cur, inc, ["k"]), inc, ["k"]).collect()}
    assert again == merged                                  # idempotent
    kinds = {r.k: r.change for r in diff(cur, inc, ["k"]).collect()}
    assert kinds == {1: "removed", 2: "changed", 3: "unchanged", 4: "added"}
    assert is_newer("20240102_000000", "20240101_000000") and not is_newer("20240101_000000", "20240101_000000")


def test_diff_null_safe(spark):
    a = spark.createDataFrame([(1, None), (2, "")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, None)], "k int, v string")
    assert {r.k: r.change for r in diff(a, b, ["k"]).collect()} == {1: "unchanged", 2: "changed"}


def test_stream_sync_idempotent(spark):
    schema = "k int, v string, export_timestamp string"
    landing = scratch_path(spark, "t-landing")
    target = scratch_path(spark, "t-target")
    ckpt = scratch_path(spark, "t-ckpt")
    s1 = spark.createDataFrame([(1, "a", "20240101_000000"), (2, "b", "20240101_000000")], schema)
    s1.write.parquet(f"{landing}/r1")
    sync_stream(spark, landing, target, ["k"], s1.schema, ckpt)
    s2 = spark.createDataFrame([(2, "B", "20240102_000000"), (3, "c", "20240102_000000")], schema)
    s2.write.parquet(f"{landing}/r2")
    s2.write.parquet(f"{landing}/r2-again")          # delivered twice
    sync_stream(spark, landing, target, ["k"], s1.schema, ckpt)
    first = sorted(tuple(r) for r in read_target(spark, target).collect())
    assert first == [(1, "a", "20240101_000000"), (2, "B", "20240102_000000"), (3, "c", "20240102_000000")]
    s1.write.parquet(f"{landing}/r1-late")            # an older snapshot arriving late
    sync_stream(spark, landing, target, ["k"], s1.schema, ckpt)
    assert sorted(tuple(r) for r in read_target(spark, target).collect()) == first


def test_schema_probes(spark):
    new = spark.createDataFrame([(1, 5)], "id int, f_cnt_up long")
    old = spark.createDataFrame([(1, None)], "id int, fcntup long")
    assert has_column(new, "F_CNT_UP") and not has_column(old, "f_cnt_up")
    assert new.select(pick_column(new, ["f_cnt_up", "fcntup"])).first()[0] == 5
    assert old.select(pick_column(old, ["f_cnt_up", "fcntup"])).first()[0] == 0
    e = empty_export(spark, ["a", "b"])
    assert e.count() == 0 and e.columns == ["a", "b"]


def test_refresh_keeps_newest_runs(spark):
    from fleetlens.catalog import open_fleet
    root = scratch_path(spark, "t-refresh")
    for day in (1, 2, 3):
        t = open_fleet(spark, "/root/testdata/sf0.001")
        res = snap.refresh(spark, t, RunContext(as_of=datetime(2024, 1, day, 12)), root, keep=2)
        assert res.published
    runs = sorted(r.run_id for r in snap.published_runs(spark, root).collect())
    assert runs == ["20240102_120000", "20240103_120000"]
    assert sorted(r.snapshot for r in snap.list_snapshots(spark, root, "devices").collect()) == runs
    assert snap.read_snapshot(spark, root, "devices").count() == 1500


def test_read_api_over_published_root(spark):
    from fleetlens.catalog import open_fleet
    from fleetlens.plans import read_api
    root = scratch_path(spark, "t-api")
    t = open_fleet(spark, "/root/testdata/sf0.001")
    assert snap.refresh(spark, t, RunContext(as_of=datetime(2024, 1, 30, 23, 58)), root).published
    info, rows = read_api.export_page(spark, root, "devices.json", page=2, limit=100)
    assert (info.total, info.total_pages, info.next_page, info.previous_page) == (1500, 15, 3, 1)
    names = [r.device_name for r in rows.collect()]
    assert len(names) == 100 and names == sorted(names)
    total, hits = read_api.search_devices(spark, root, "DEV-1")
    assert total > 100 and hits.count() == 100
    listing = read_api.codecs(spark, root)
    assert listing.count() == 168
    first = listing.orderBy("name").first()
    assert read_api.codec(spark, root, first.name).count() == 1
    st = read_api.stats(spark, root)
    assert st.exports_available == 20 and st.codecs_available == 168
    assert st.device_summary.count() == 25
    assert read_api.health(spark, root).first().status == "ok"


def test_exports_on_an_older_schema(spark):
    """Older servers: ``fcntup`` instead of ``f_cnt_up``, no ping-slot column
    on multicast groups, no FUOTA table."""
    from fleetlens.catalog import open_fleet
    from fleetlens.plans.exports import EXPORTS, FUOTA_COLUMNS
    base = open_fleet(spark, "/root/testdata/sf0.001")
    old = {**{n: base[n] for n in base},
           "device": base["device"].withColumnRenamed("f_cnt_up", "fcntup"),
           "multicast_group": base["multicast_group"].drop("class_b_ping_slot_periodicity")}
    ctx = RunContext(as_of=datetime(2024, 1, 30, 23, 58))
    new_dev = {r.device_eui: r.frame_counter_up for r in EXPORTS["devices"].build(base, ctx).collect()}
    old_dev = {r.device_eui: r.frame_counter_up for r in EXPORTS["devices"].build(old, ctx).collect()}
    assert old_dev == new_dev
    mg = EXPORTS["multicast_groups"].build(old, ctx)
    assert mg.filter("class_b_ping_slot_periodicity IS NOT NULL").count() == 0 and mg.count() == 200

    without = {n: base[n] for n in base if n != "fuota_deployment"}
    empty = EXPORTS["fuota_deployments"].build(without, ctx)
    assert empty.count() == 0 and tuple(empty.columns) == FUOTA_COLUMNS


def test_json_array_file_and_server_union(spark, tmp_path):
    import json as _json
    from fleetlens.operators.setops import combine_servers
    # the reference's read API serves one JSON array per export, values as text
    path = tmp_path / "tenants.json"
    path.write_text(_json.dumps([{"tenant_id": "1", "tenant_name": "a", "description": ""},
                                 {"tenant_id": "2", "tenant_name": "b", "description": "x"}], indent=2))
    df = files.read_json_export(spark, str(path), files.all_string(["tenant_id", "tenant_name", "description"]),
                                array_file=True)
    assert sorted((r.tenant_id, r.description) for r in df.collect()) == [("1", ""), ("2", "x")]
    # two servers, the older one without a column: union by name, NULL for the gap
    new = spark.createDataFrame([("s1", "1", 5)], "source_server string, id string, max_device_count int")
    old = spark.createDataFrame([("s2", "1")], "source_server string, id string")
    both = {(r.source_server, r.id): r.max_device_count for r in combine_servers([new, old]).collect()}
    assert both == {("s1", "1"): 5, ("s2", "1"): None}


def test_csv_as_database_text(spark):
    rows = [(True, datetime(2024, 1, 1, 1, 2, 3), None, ""), (False, datetime(2024, 1, 1, 1, 2, 3, 500000), "x", None)]
    df = spark.createDataFrame(rows, "b boolean, t timestamp_ntz, s string, e string")
    path = scratch_path(spark, "t-csv-db")
    snap.write_csv(df.coalesce(1), path, as_database_text=True)
    text = "".join(r.value + "\n" for r in spark.read.text(path).collect())
    assert text.splitlines()[0] == "b,t,s,e"
    assert 't,2024-01-01 01:02:03,,""' in text and "f,2024-01-01 01:02:03.5,x," in text


def test_stream_sync_from_archive_layout(spark):
    from fleetlens.catalog import open_fleet
    from fleetlens.plans.exports import EXPORTS
    t = open_fleet(spark, "/root/testdata/sf0.001")
    root = scratch_path(spark, "t-archive-sync")
    target = scratch_path(spark, "t-archive-target")
    ckpt = scratch_path(spark, "t-archive-ckpt")
    schema = EXPORTS["devices"].build(t, RunContext()).schema
    keys = ["source_server", "device_eui"]
    for day in (29, 30):
        c = RunContext(as_of=datetime(2024, 1, day, 23, 58))
        assert snap.run_exports(spark, t, c, root, ("devices",), with_codecs=False).published
        sync_stream(spark, f"{root}/archive/devices", target, keys, schema, ckpt)
    out = read_target(spark, target)
    assert out.count() == 1500
    assert {r[0] for r in out.select("export_timestamp").distinct().collect()} == {"20240130_235800"}


def test_refresh_removes_failed_runs(spark):
    from fleetlens.catalog import open_fleet
    root = scratch_path(spark, "t-failed")
    t = open_fleet(spark, "/root/testdata/sf0.001")

    def bad():
        raise RuntimeError("source down")
    c1 = RunContext(as_of=datetime(2024, 1, 1, 12))
    failed = snap.run_exports(spark, t, c1, root, ("tenants", "devices"), extra={"x": bad}, with_codecs=False)
    assert not failed.published and c1.run_id in snap.run_folders(spark, root)
    snap.refresh(spark, t, RunContext(as_of=datetime(2024, 1, 2, 12)), root, keep=5)
    folders = snap.run_folders(spark, root)
    assert c1.run_id not in folders and "20240102_120000" in folders

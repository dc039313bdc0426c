"""Digest trees, summaries kept by deltas, contents stored once, schema reconciliation."""

import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.context import RunContext
from fleetlens.operators.setops import diff
from fleetlens.plans.exports import device_rollup_by_application, gateway_rollup_by_tenant
from fleetlens.session import scratch_path
from fleetlens.sinks import codec_store, digest_tree, kept_summary, keyed_store
from fleetlens.sinks import snapshot as snap
from fleetlens.sources.reconcile import SchemaConflict, meet, read_servers, reconcile


# ------------------------------------------------------------ digest trees

def _tree(spark, df, keys=("id",), **kw):
    path = scratch_path(spark, "t-tree")
    digest_tree.write_tree(df, path, keys, **kw)
    return path


def test_one_changed_row_in_a_million(spark):
    df = spark.range(1_000_000).select("id", (F.col("id") * 7).alias("v"), F.lit("x").alias("export_timestamp"))
    old = _tree(spark, df)
    new = _tree(spark, df.withColumn("v", F.when(F.col("id") == 777_777, -1).otherwise(F.col("v"))).withColumn(
        "export_timestamp", F.lit("y")))
    out = digest_tree.tree_diff(spark, old, new, ["id"])
    assert [tuple(r) for r in out.collect()] == [(777_777, "changed")]
    read = [f for f in out.inputFiles() if "/rows/" in f]
    assert {f.split("/part=")[1].split("/")[0] for f in read} == {read[0].split("/part=")[1].split("/")[0]}
    same = digest_tree.tree_diff(spark, old, _tree(spark, df.repartition(3)), ["id"])
    assert same.count() == 0


def test_tree_diff_equals_a_join(spark):
    r = random.Random(3)
    schema = "id int, sub string, v string, w string"
    old = [(i if i % 11 else None, f"s{i % 3}", r.choice(["a", None, ""]), r.choice(["b", None])) for i in range(1, 400)]
    new = [(i, s, v if r.random() < 0.8 else "z", w) for i, s, v, w in old[30:]] + [(900 + i, "n", "a", "b") for i in range(20)]
    a = spark.createDataFrame(old, schema).dropDuplicates(["id", "sub"])
    b = spark.createDataFrame(new, schema).dropDuplicates(["id", "sub"])
    for frame in (a, b):
        frame.cache()
    got = digest_tree.tree_diff(spark, _tree(spark, a, ("id", "sub"), parts=4, leaves=4),
                                _tree(spark, b, ("id", "sub"), parts=4, leaves=4), ("id", "sub"))
    one = [x.fillna({"id": -1}) for x in (a, b)]
    want = diff(*one, ("id", "sub")).filter("change <> 'unchanged'")
    assert sorted(tuple(r) for r in got.fillna({"id": -1}).collect()) == sorted(tuple(r) for r in want.collect())


def test_moved_nulls_and_repeated_rows_are_changes(spark):
    schema = "id int, a string, b string"
    old = _tree(spark, spark.createDataFrame([(1, None, "x"), (2, "q", "q"), (3, "r", "r")], schema))
    new = _tree(spark, spark.createDataFrame([(1, "x", None), (2, "q", "q"), (2, "q", "q")], schema))
    got = {r["id"]: r["change"] for r in digest_tree.tree_diff(spark, old, new, ["id"]).collect()}
    assert got == {1: "changed", 2: "changed", 3: "removed"}
    none = _tree(spark, spark.createDataFrame([], schema))
    assert digest_tree.tree_diff(spark, none, none, ["id"]).count() == 0
    assert {r["change"] for r in digest_tree.tree_diff(spark, none, old, ["id"]).collect()} == {"added"}
    assert digest_tree.tree_diff(spark, old, none, ["id"]).filter("change = 'removed'").count() == 3


def test_changes_between_runs(spark):
    root = scratch_path(spark, "t-changes")
    for rid, rows in (("20240101_000000", [(1, "a"), (2, "b")]), ("20240102_000000", [(2, "B"), (3, "c")])):
        snap.write_snapshot(spark.createDataFrame(rows, "id int, v string"), root, "things", rid, ordered=False)
    args = (spark, root, "things", "20240101_000000", "20240102_000000", ["id"])
    want = {1: "removed", 2: "changed", 3: "added"}
    assert {r["id"]: r["change"] for r in digest_tree.run_changes(*args).collect()} == want
    for rid in args[3:5]:
        digest_tree.write_run_tree(spark, root, "things", rid, ["id"])
    out = digest_tree.run_changes(*args)
    assert {r["id"]: r["change"] for r in out.collect()} == want and all("digests-things" in f for f in out.inputFiles())


# ------------------------------------------------------------ summaries kept by deltas

DEVICE = ("dev_eui string, application_id long, is_disabled boolean, battery_level double, enabled_class string, "
          "last_seen_at timestamp_ntz, v int")
GATEWAY = "gateway_id string, tenant_id int, last_seen_at timestamp_ntz, v int"
START = datetime(2024, 1, 10, 12)


def _seen(r, now, near):
    return r.choice([None, now - timedelta(seconds=r.choice(near)), now - timedelta(minutes=r.randrange(30_000))])


def _kept(spark, key, schema, spec, runs):
    """Counters kept over ``runs`` (context, rows changed since the last one), and the rows of each run."""
    store, path = scratch_path(spark, "t-store"), scratch_path(spark, "t-kept")
    before, out = None, []
    for k, (c, rows) in enumerate(runs):
        keyed_store.merge(spark, store, spark.createDataFrame(rows, schema), [key], ["v"], f"{k}.t", buckets=8)
        names = [n for _, n in keyed_store.versions(spark, store)]
        now = keyed_store.read_store(spark, store)
        if before is None:
            kept_summary.start(spark, path, now, spec, c)
        else:
            kept_summary.advance(spark, path, keyed_store.changed_rows(spark, store, [key], *names[-2:]), spec, before, c)
        out.append((kept_summary.read_state(spark, path), device_rows(now, c) if key == "dev_eui" else gateway_rows(now, c)))
        before = c
    return path, out


def device_rows(df, c):
    return {r["application_id"]: r.asDict() for r in device_rollup_by_application(df, c).collect()}


def gateway_rows(df, c):
    return {r["tenant_id"]: r.asDict() for r in gateway_rollup_by_tenant(df, c).collect()}


def _runs(seed, make, steps):
    r, rows, out, now = random.Random(seed), {}, [], START
    for k, step in enumerate(steps):
        now += step
        for i in (range(120) if k == 0 else r.sample(range(150), 25)):
            rows[i] = make(r, i, k, now)
        out.append((RunContext(as_of=now), [x for x in rows.values() if x[-1] == k]))
    return out


STEPS = [timedelta(0), timedelta(minutes=15), timedelta(hours=24), timedelta(seconds=1), timedelta(days=6), timedelta(days=9), timedelta(hours=1)]


def test_device_counters_equal_recomputed_ones(spark):
    day = 24 * 3600

    def make(r, i, k, now):
        return (f"d{i}", r.choice([1, 2, 3, None]), r.choice([True, False, None]), r.choice([None, 5.5, 20.0, 80.25]),
                r.choice(["A", "B", "C", None]), _seen(r, now, [0, day, day + 1, day - 900, 7 * day, -3600]), k)
    spec = kept_summary.device_spec()
    _, states = _kept(spark, "dev_eui", DEVICE, spec, _runs(1, make, STEPS))
    shared = [c for c in spec.counters if c not in ("rows", "never_seen", "battery_sum")]
    for state, want in states:
        got = {r["application_id"]: r.asDict() for r in state.collect()}
        assert set(got) == set(want)
        for app, w in want.items():
            assert {c: got[app][c] for c in shared} == {c: w[c] for c in shared}
            assert float(got[app]["battery_sum"]) == (w["battery_sum"] or 0)


def test_gateway_counters_equal_recomputed_ones(spark):
    def make(r, i, k, now):
        return (f"g{i}", r.choice([1, 2, None]), _seen(r, now, [0, 300, 299, 301, 3600, 3599, 3601, 600]), k)
    spec = kept_summary.gateway_spec()
    steps = [timedelta(0), timedelta(minutes=5), timedelta(minutes=55), timedelta(seconds=1), timedelta(hours=3)]
    _, states = _kept(spark, "gateway_id", GATEWAY, spec, _runs(2, make, steps))
    for state, want in states:
        got = {r["tenant_id"]: [r[c] for c in spec.counters] for r in state.collect()}
        assert got == {t: [w[c] for c in spec.counters] for t, w in want.items()}


def test_only_due_days_are_read_and_unfinished_runs_are_not(spark):
    spec, path = kept_summary.device_spec(), scratch_path(spark, "t-due")
    rows = [(f"d{i}", 1, False, None, "A", START - timedelta(days=i), 0) for i in range(7)]
    df = spark.createDataFrame(rows, DEVICE)
    a, b = RunContext(as_of=START), RunContext(as_of=START + timedelta(hours=20))
    kept_summary.start(spark, path, df, spec, a)
    due = kept_summary.due(spark, path, spec, a, b)
    assert "PartitionFilters: [isnotnull(day" in due._jdf.queryExecution().toString()
    assert due.count() == 0
    c = RunContext(as_of=START + timedelta(hours=24))
    assert sorted((r["counter"], r["change"]) for r in kept_summary.due(spark, path, spec, a, c).collect()) == [
        ("devices_seen_24h", -1), ("devices_seen_7d", -1)]
    # a run that failed after its events: no state, its events are not read
    (spark.createDataFrame([(1, "devices_seen_24h", START + timedelta(hours=1), -99)],
                           "application_id long, counter string, at timestamp_ntz, change bigint")
     .withColumn("day", F.lit(20240110)).write.partitionBy("day").parquet(f"{path}/events/run=20240110_130000"))
    assert kept_summary.due(spark, path, spec, a, c).count() == 2


# ------------------------------------------------------------ codec contents

def _files(path):
    path = path.removeprefix("file:")
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_codec_contents_are_stored_once_and_swept(spark):
    devices = spark.createDataFrame([(i,) for i in range(1, 7)], "device_profile_id long")

    def tables(scripts):
        rows = [(i, f"profile {i}", s) for i, s in scripts.items()]
        return {"device": devices, "device_profile": spark.createDataFrame(rows, "id long, name string, payload_codec_script string")}
    root = scratch_path(spark, "t-codecs")
    first = {1: "same", 2: "same", 3: "old", 4: "kept", 5: " ", 6: None}
    assert codec_store.write_run(spark, tables(first), root, "r1") == 3
    before = _files(codec_store.objects_path(root))
    assert codec_store.write_run(spark, tables(first), root, "r2") == 0          # unchanged: no script byte
    assert _files(codec_store.objects_path(root)) == before
    third = {**first, 3: "new", 5: "fresh"}
    assert codec_store.write_run(spark, tables(third), root, "r3") == 2
    assert codec_store.write_run(spark, tables(third), root, "r3") == 2          # a retry writes the same folder

    def scripts(run):
        return sorted(r["script"] for r in codec_store.read_run(spark, root, run).collect())
    assert scripts("r1") == scripts("r2") == ["kept", "old", "same", "same"]
    assert scripts("r3") == ["fresh", "kept", "new", "same", "same"]
    assert codec_store.sweep(spark, root, ["r1", "r2", "r3"]) == {}
    snap.delete_paths(spark, [codec_store.refs_path(root, "r1")])
    assert codec_store.sweep(spark, root, ["r2", "r3"]) == {}                     # r2 still refers to all of r1's
    snap.delete_paths(spark, [codec_store.refs_path(root, "r2")])
    assert codec_store.sweep(spark, root, ["r3"]) == {"r1": 2}                    # "old" alone goes
    assert scripts("r3") == ["fresh", "kept", "new", "same", "same"]
    left = [r["script"] for r in codec_store.read_objects(spark, root).collect()]
    assert sorted(left) == ["fresh", "kept", "new", "same"]


# ------------------------------------------------------------ schema reconciliation

def _s(ddl):
    return T.StructType.fromDDL(ddl)


@pytest.mark.parametrize("a, b, want", [
    ("smallint", "bigint", "bigint"), ("int", "decimal(5,2)", "decimal(12,2)"), ("int", "double", "double"),
    ("float", "int", "double"), ("date", "timestamp_ntz", "timestamp_ntz"), ("void", "string", "string"),
    ("decimal(10,2)", "decimal(8,6)", "decimal(14,6)"), ("array<int>", "array<bigint>", "array<bigint>"),
    ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>"),
    ("bigint", "double", None), ("string", "int", None), ("boolean", "int", None), ("timestamp", "timestamp_ntz", None),
    ("decimal(38,0)", "decimal(38,10)", None), ("struct<a:int>", "struct<a:string>", None), ("binary", "string", None)])
def test_types_meet(a, b, want):
    x, y = (_s(f"c {t}")["c"].dataType for t in (a, b))
    got = {m.simpleString() if m else None for m in (meet(x, y), meet(y, x))}
    assert got == {want}


def test_conflicts_name_the_column():
    with pytest.raises(SchemaConflict, match="level: string in a, bigint in b, double in c"):
        reconcile({"a": _s("id int, level string"), "b": _s("id int, level bigint"), "c": _s("LEVEL double")})


def test_roots_of_three_versions(spark):
    frames = {
        "new": spark.createDataFrame([(1, 10, 1.5, datetime(2024, 1, 1, 5), "new")], "id bigint, counter bigint, level double, at timestamp_ntz, tag string"),
        "mid": spark.createDataFrame([(2, 20, 7)], "ID int, f_cnt int, level smallint"),
        "old": spark.createDataFrame([(date(2023, 5, 5), 30, 3, 99)], "at date, fcnt smallint, id smallint, counter int"),
        "bare": spark.createDataFrame([], "id tinyint"),
    }
    roots = {}
    for name, df in frames.items():
        roots[name] = scratch_path(spark, f"t-{name}")
        df.write.parquet(roots[name])
    out = read_servers(spark, roots, {"counter": ["f_cnt", "fcnt"]})
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [
        ("id", "bigint"), ("counter", "bigint"), ("level", "double"), ("at", "timestamp_ntz"), ("tag", "string")]
    assert sorted(map(tuple, out.collect())) == [
        (1, 10, 1.5, datetime(2024, 1, 1, 5), "new"), (2, 20, 7.0, None, None),
        (3, 99, None, datetime(2023, 5, 5), None)]           # its own name goes before an older one
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()

"""Queries over the life of the exports: files written and read back,
snapshots, retention, upsert, differences and the streaming sync.

Each writes under the session's shared checkpoint folder (never a
machine-local path) and returns a deterministic frame for comparison.
"""

from __future__ import annotations

from datetime import timedelta
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.context import RunContext
from fleetlens.functions.exprs import non_blank, sync_status_columns
from fleetlens.operators.setops import diff, upsert_if_newer
from fleetlens.plans.exports import EXPORTS, LARGE_EXPORTS, RUN_EXPORTS, device_lookups, device_summary_of
from fleetlens.session import PACKED, dropped_shuffles, scratch_path
from fleetlens.sinks import codec_store, digest_tree, directory, kept_summary, keyed_store
from fleetlens.sinks import snapshot as snap
from fleetlens.sources import files, reconcile
from fleetlens.sources.tables import LazyTables
from fleetlens.streaming.sync import read_target, sync_published

DEVICE_KEYS = ("source_server", "device_eui")


def _spark(t) -> SparkSession:
    return t["tenant"].sparkSession


def previous_run(ctx: RunContext, days: int = 1) -> RunContext:
    return RunContext(as_of=ctx.as_of - timedelta(days=days), server_name=ctx.server_name,
                      server_url=ctx.server_url)


def written_once(t, root: str, **frames: DataFrame) -> LazyTables:
    """The tables with these frames, each written once below ``root`` and read back, for
    queries that use one several times."""
    spark = _spark(t)
    with dropped_shuffles(spark):
        for name, df in frames.items():
            df.write.mode("overwrite").options(**PACKED).parquet(f"{root}/{name}")
    return LazyTables({**{n: (lambda n=n: t[n]) for n in t},
                       **{n: (lambda n=n: spark.read.parquet(f"{root}/{n}")) for n in frames}})


# ------------------------------------------------------------ round trips

def csv_roundtrip(t, ctx: RunContext) -> DataFrame:
    """K1 + S4: the gateway export, with a text column of awkward values
    (outer spaces, a tab, line breaks, quotes, '' and NULL), written as CSV
    and read back typed."""
    spark = _spark(t)
    df = EXPORTS["gateways"].build(t, ctx)
    last, name = F.substring("gateway_eui", -1, 1), F.col("gateway_name")
    df = df.withColumn("note", F.when(last == "0", F.concat(F.lit("  "), name, F.lit(" ")))
                       .when(last == "1", F.lit("\t")).when(last == "2", F.concat(name, F.lit("\r\nnext")))
                       .when(last == "3", F.lit("")).when(last == "4", F.lit(None))
                       .when(last == "5", F.concat(F.lit('"q", '), name)).otherwise(name))
    path = scratch_path(spark, "csv")
    snap.write_csv(df, path)
    return files.read_csv_export(spark, path, schema=df.schema)


def json_roundtrip(t, ctx: RunContext) -> DataFrame:
    """K2 + S5: the device-profile export as the read API serves it (every
    value text, NULL as '', booleans t/f), written as JSON and read back."""
    spark = _spark(t)
    df = EXPORTS["device_profiles"].build(t, ctx)
    path = scratch_path(spark, "json")
    snap.write_json(df, path, stringly_typed=True)
    return files.read_json_export(spark, path, files.all_string(df.columns))


# ------------------------------------------------------------ codecs on disk

def _written_codecs(t, ctx: RunContext) -> str:
    spark = _spark(t)
    path = scratch_path(spark, "codecs")
    snap.write_codecs(t, path)
    return path


def codec_listing(t, ctx: RunContext) -> DataFrame:
    """K3 + S8: the codec dataset written and listed."""
    spark = _spark(t)
    return files.list_codecs(spark, _written_codecs(t, ctx))


def codec_by_name(t, ctx: RunContext) -> DataFrame:
    """Every listed codec fetched by name twice, with and without the
    optional ``.js`` suffix (a join of the requests with the dataset, the set
    form of one lookup per request); both forms must find the same file."""
    spark = _spark(t)
    path = _written_codecs(t, ctx)
    listing = files.list_codecs(spark, path)
    requested = (listing.select(F.col("name").alias("requested"), F.lit(False).alias("with_suffix"))
                 .unionByName(listing.select(F.col("codec_file").alias("requested"),
                                             F.lit(True).alias("with_suffix"))))
    wanted = requested.select("with_suffix", F.when(F.col("requested").endswith(".js"), F.col("requested"))
                              .otherwise(F.concat(F.col("requested"), F.lit(".js"))).alias("codec_file"))
    contents = spark.read.parquet(path).select("codec_file", "script")
    found = wanted.join(contents, "codec_file")
    return found.select("codec_file", "with_suffix", (F.octet_length("script") + 1).alias("size_bytes"),
                        F.length("script").alias("script_chars"))


def codec_completeness(t, ctx: RunContext) -> DataFrame:
    """K4: expected vs written codec files."""
    from fleetlens.plans.exports import codec_files
    spark = _spark(t)
    written = files.list_codecs(spark, _written_codecs(t, ctx))
    return snap.check_codecs(codec_files(t), written)


# ------------------------------------------------------------ runs and snapshots

_RUN_CACHE: dict = {}


def two_runs(t, ctx: RunContext) -> str:
    """Two published runs (yesterday's and today's) of every export, once
    per session and input; today's also as CSV and JSON. Both read the source
    tables, and the rows of the large exports with their lookups, as they were written once
    before them; such rows go as soon as today's run has written them, the tables when it has
    written all that is made from them."""
    spark = _spark(t)
    key = (spark.sparkContext.applicationId, id(t), ctx.run_id)
    if key not in _RUN_CACHE:
        root = scratch_path(spark, "runs")
        staging = f"{root}/staging/snapshot={ctx.run_id}"
        large = {n: known for n, known in LARGE_EXPORTS.items() if known.source in t}
        inner = {known.source for known in large.values()}
        sources = snap.stage_sources(spark, t, root, ctx.run_id,
                                     [n for n in (*snap.RUN_SOURCES, "server") if n in t and n not in inner], 4)
        tables = snap.glob_paths(spark, f"{staging}/*")
        for known in large.values():
            sources = written_once(sources, staging, **{known.table: known.build(sources)})
        waiting, turn = {*RUN_EXPORTS, snap.CODECS} - set(large), Lock()  # what is made from the tables

        def written(name):
            if name in large:
                snap.delete_paths(spark, [f"{staging}/{large[name].table}"])
                return
            with turn:
                waiting.discard(name)
                if not waiting:
                    snap.delete_paths(spark, tables)

        for c in (previous_run(ctx), ctx):
            snap.run_exports(spark, sources, c, root, parallelism=4,
                             formats=("parquet", "csv", "json") if c is ctx else ("parquet",), indexes=("pages", "search"),
                             written=written if c is ctx else None)
        snap.delete_paths(spark, [staging])  # nothing reads it after the runs
        _RUN_CACHE[key] = root
    return _RUN_CACHE[key]


def archive_current(t, ctx: RunContext) -> DataFrame:
    """K5 + K6: the device summary as the current (newest published) run."""
    spark = _spark(t)
    root = two_runs(t, ctx)
    return snap.read_snapshot(spark, root, "device_summary")


def list_exports_view(t, ctx: RunContext) -> DataFrame:
    """Exports of the current run; sizes and file counts depend on the
    writer, so the query says whether there are any."""
    spark = _spark(t)
    return snap.list_exports(spark, two_runs(t, ctx)).select(
        "name", "filename", (F.col("size") > 0).alias("has_bytes"), (F.col("files") > 0).alias("has_files"))


def _read_text_run(t, ctx: RunContext, form: str) -> DataFrame:
    """Rows and rows' text length of every export of the current run, read back
    from its CSV or JSON form."""
    spark = _spark(t)
    root = two_runs(t, ctx)
    parts = []
    for name in RUN_EXPORTS:
        schema = EXPORTS[name].build(t, ctx).schema
        path = snap.text_path(root, form, name, ctx.run_id)
        df = (files.read_csv_export(spark, path, schema=schema) if form == "csv"
              else files.read_json_export(spark, path, files.all_string(schema.names)))
        filled = sum((F.coalesce(F.col(c).cast("string"), F.lit("")) != "").cast("int") for c in schema.names)
        parts.append(df.agg(F.lit(name).alias("export_name"), F.count(F.lit(1)).alias("records"),
                            F.coalesce(F.sum(filled), F.lit(0)).cast("bigint").alias("filled_values")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_csv(t, ctx: RunContext) -> DataFrame:
    """K1 + S4: every export of a run read back from CSV."""
    return _read_text_run(t, ctx, "csv")


def run_json(t, ctx: RunContext) -> DataFrame:
    """K2 + S5: every export of a run read back from JSON."""
    return _read_text_run(t, ctx, "json")


def fetch_export(t, ctx: RunContext, name: str = "tenant_user_roles.json") -> DataFrame:
    """One export of the current run by name, with its row count."""
    df, total = files.get_export(_spark(t), two_runs(t, ctx), name)
    return df.withColumn("total_records", F.lit(total).cast("bigint"))


def fetch_codec(t, ctx: RunContext) -> DataFrame:
    """The first codec of the listing, fetched by its name."""
    spark = _spark(t)
    path = _written_codecs(t, ctx)
    first = files.list_codecs(spark, path).orderBy("name").limit(1).first()
    if first is None:
        return files.get_codec(spark, path, "").select("codec_file", F.length("script").alias("script_chars"))
    return files.get_codec(spark, path, first["name"]).select("codec_file", F.length("script").alias("script_chars"))


def manifest_view(t, ctx: RunContext) -> DataFrame:
    """Listing of the current run joined with the counts gathered while it was written."""
    spark = _spark(t)
    root = two_runs(t, ctx)
    rid = snap.current_run_id(spark, root)
    counts = snap.run_manifest(spark, root, rid).select("export_name", "records")
    return snap.manifest(snap.list_exports(spark, root, rid), counts).select(
        "name", (F.col("files") > 0).alias("has_files"), "records")


def gathered_counts(t, ctx: RunContext) -> DataFrame:
    """K9: what the current run's manifest holds of every export: rows, smallest and
    largest key, and the NULLs of all its columns together."""
    spark = _spark(t)
    m = snap.run_manifest(spark, two_runs(t, ctx)).filter(F.col("export_name") != snap.CODECS)
    nulls = F.aggregate(F.map_values(F.coalesce("null_counts", F.create_map().cast("map<string, bigint>"))),
                        F.lit(0).cast("bigint"), lambda a, x: a + x)
    return m.select("export_name", "records", "first_key", "last_key", nulls.alias("null_values"))


def export_order(t, ctx: RunContext) -> DataFrame:
    """L1 + L2: the place of every row of every sorted export of the current run, from
    the page directory and the row's place in its file, with the row's identifying
    columns as text."""
    spark = _spark(t)
    root = two_runs(t, ctx)
    rid = snap.current_run_id(spark, root)
    out = None
    for name in RUN_EXPORTS:
        if not directory.order_keys(name) or not EXPORTS[name].unique:
            continue
        files_ = directory.read_directory(spark, root, rid, name).orderBy("ordinal").collect()  # a row per file
        rows = directory.placed(spark, root, rid, name, files_) if files_ else None
        if rows is not None:
            key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in EXPORTS[name].unique])
            rows = rows.select(F.lit(name).alias("export_name"), F.col("__place").alias("place"), key.alias("row_key"))
            out = rows if out is None else out.unionByName(rows)
    return out


def current_devices_page(t, ctx: RunContext, page: int = 3, limit: int = 100) -> DataFrame:
    """V7 on the read path: a page of the published device export by the page directory."""
    from fleetlens.plans import read_api
    return read_api.export_page(_spark(t), two_runs(t, ctx), "devices", page, limit)[1]


def current_device_by_eui(t, ctx: RunContext) -> DataFrame:
    """F6 on the read path: the published device of the smallest EUI, fetched by it, and
    of an EUI that no device has (no row)."""
    from fleetlens.plans import read_api
    spark, root = _spark(t), two_runs(t, ctx)
    first = snap.run_manifest(spark, root).filter("export_name = 'devices'").first()["first_key"]
    return (read_api.device_by_eui(spark, root, first or "")
            .unionByName(read_api.device_by_eui(spark, root, "no such device")))


#: Needles of the search cases: one, two and three characters, an application name
#: in part, a whole EUI and one that nothing holds.
SEARCH_CASES = ("7", "V-", "dev", "#00000012", "0000000000000001", "r#000000077", "no such device at all")


def current_search_cases(t, ctx: RunContext) -> DataFrame:
    """F9 on the read path, by the index: several needles, each with its total and the
    first hundred devices (one row without a device where nothing matches)."""
    from fleetlens.plans import read_api
    spark, root = _spark(t), two_runs(t, ctx)
    out = None
    for q in SEARCH_CASES:
        total, rows = read_api.search_devices(spark, root, q)
        rows = rows.select(F.col("device_eui"))
        if not total:
            rows = spark.createDataFrame([(None,)], "device_eui string")
        rows = rows.select(F.lit(q).alias("query"), F.lit(total).cast("bigint").alias("match_count"), "device_eui")
        out = rows if out is None else out.unionByName(rows)
    return out


def run_stats(t, ctx: RunContext) -> DataFrame:
    """V1 from the published run: exports and codecs counted in its folders,
    totals of both written summaries."""
    from fleetlens.plans import read_api
    st = read_api.stats(_spark(t), two_runs(t, ctx))
    both = st.device_summary.select("tenant_id", "total_devices", "active_devices").unionByName(
        st.gateway_summary.select("total_gateways", "online_gateways"), allowMissingColumns=True)
    return both.agg(F.lit(st.server_name).alias("server_name"), F.lit(st.last_export).alias("last_export"),
                    F.lit(st.exports_available).cast("bigint").alias("exports_available"),
                    F.lit(st.codecs_available).cast("bigint").alias("codecs_available"),
                    F.count("tenant_id").alias("tenants"),
                    *[F.sum(c).cast("bigint").alias(c) for c in
                      ("total_devices", "active_devices", "total_gateways", "online_gateways")])


def _devices_per_run(spark: SparkSession, root: str) -> DataFrame:
    """Device records of every published run."""
    runs = [r["run_id"] for r in snap.published_runs(spark, root).select("run_id").collect()]  # a row per kept run
    base = f"{root.rstrip('/')}/archive/devices"
    d = spark.read.option("basePath", base).parquet(*[snap.snapshot_path(root, "devices", r) for r in runs])
    return (d.groupBy(F.col("snapshot").cast("string").alias("run_id"))
            .agg(F.count(F.lit(1)).alias("device_records"), F.max("last_seen_at").alias("last_contact")))


def health(t, ctx: RunContext) -> DataFrame:
    """Health row: status, last export and server from the current
    metadata, and the device records and last contact of that run."""
    spark = _spark(t)
    root = two_runs(t, ctx)
    rid = snap.current_run_id(spark, root)
    meta = files.read_metadata(spark, f"{root}/archive/_metadata/snapshot={rid}")
    d = snap.read_snapshot(spark, root, "devices", rid)
    m = meta.first()
    return d.agg(F.lit("ok").alias("status"), F.lit(m["export_date"] or "unknown").alias("last_export"),
                 F.lit(m["server_name"] or "unknown").alias("server"),
                 F.count(F.lit(1)).alias("device_records"), F.max("last_seen_at").alias("last_contact"))


def sync_freshness(t, ctx: RunContext, checked_after_minutes: int = 20) -> DataFrame:
    """Age of every published run's export when checked 20 minutes
    after this run, next due time, healthy flag."""
    spark = _spark(t)
    root = two_runs(t, ctx)
    runs = snap.published_runs(spark, root)
    export_ts = F.to_timestamp_ntz(F.substring(F.col("export_date"), 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    check = RunContext(as_of=ctx.as_of + timedelta(minutes=checked_after_minutes))
    cols = sync_status_columns(export_ts, check)
    out = runs.select("run_id", *[v.alias(k) for k, v in cols.items()])
    return out.join(_devices_per_run(spark, root), "run_id", "left")


def current_device_search(t, ctx: RunContext, q: str = "42") -> DataFrame:
    """F9 on the read path: the device search over the published device
    export of the current run, with the total before the cap."""
    from fleetlens.plans import read_api
    spark = _spark(t)
    total, rows = read_api.search_devices(spark, two_runs(t, ctx), q)
    return rows.withColumns({"query": F.lit((q or "").lower()), "match_count": F.lit(total).cast("bigint")})


def record_counts_view(t, ctx: RunContext) -> DataFrame:
    """K9: rows of every export of a run (one job)."""
    return snap.record_counts({n: EXPORTS[n].build(t, ctx) for n in RUN_EXPORTS})


def record_totals_view(t, ctx: RunContext) -> DataFrame:
    """Total records and number of exports of a run."""
    return snap.record_totals(record_counts_view(t, ctx))


def export_run_status(t, ctx: RunContext) -> DataFrame:
    """A run of every export and one that fails: the others are written,
    the failure is recorded, and the run is not published."""
    spark = _spark(t)
    root = scratch_path(spark, "status")

    def broken():  # a source table this server does not have
        return spark.read.parquet(f"{root}/no_such_table")

    res = snap.run_exports(spark, t, ctx, root, extra={"broken_export": broken}, with_codecs=False, stage=True, parallelism=4)
    published = snap.current_run_id(spark, root) is not None
    return res.status.select("export_name", "ok", "records", F.col("error").isNotNull().alias("has_error"),
                             F.lit(published).alias("run_published"))


def retention(t, ctx: RunContext, runs: int = 12, keep: int = 10) -> DataFrame:
    """K8: twelve hourly snapshots of the gateway summary (each computed from
    all gateways at its own time); those beyond the newest ten are deleted, and
    the kept ones are read back."""
    spark = _spark(t)
    root = scratch_path(spark, "retention")
    for k in range(runs):
        c = RunContext(as_of=ctx.as_of - timedelta(hours=k), server_name=ctx.server_name)
        snap.write_snapshot(EXPORTS["gateway_summary"].build(t, c), root, "gateway_summary", c.run_id)
    ranked = snap.expired_snapshots(snap.list_snapshots(spark, root, "gateway_summary"), keep)
    gone = [r["snapshot"] for r in ranked.filter("NOT keep").collect()]  # a row per run
    snap.delete_paths(spark, [snap.snapshot_path(root, "gateway_summary", r) for r in gone])
    base = f"{root}/archive/gateway_summary"
    kept = (spark.read.option("basePath", base).parquet(base).groupBy(F.col("snapshot").cast("string").alias("snapshot"))
            .agg(F.count(F.lit(1)).alias("tenants"), F.sum("total_gateways").alias("gateways"),
                 F.sum("online_gateways").alias("online")))
    left = snap.expired_snapshots(snap.list_snapshots(spark, root, "gateway_summary"), keep)
    return left.join(kept, "snapshot", "left")


# ------------------------------------------------------------ upsert / diff / stream

def _device_snapshots(t, ctx: RunContext) -> tuple[DataFrame, DataFrame]:
    """Yesterday's full device export and today's export of seen devices. The lookups,
    which do not depend on the day, are written once for both."""
    t = written_once(t, scratch_path(_spark(t), "lookups"), device_lookups=device_lookups(t))
    old = EXPORTS["devices"].build(t, previous_run(ctx))
    new = EXPORTS["devices"].build(t, ctx).filter(F.col("activity_status") != "Never")
    return old, new


def upsert_devices(t, ctx: RunContext) -> DataFrame:
    """U2 + U4: today's export upserted into yesterday's by key."""
    old, new = _device_snapshots(t, ctx)
    return upsert_if_newer(old, new, DEVICE_KEYS, ctx.run_id, previous_run(ctx).run_id)


def snapshot_diff(t, ctx: RunContext) -> DataFrame:
    """Per device, added / removed / changed / unchanged."""
    old, new = _device_snapshots(t, ctx)
    return diff(old, new, DEVICE_KEYS).select("device_eui", "change")


def snapshot_changes(t, ctx: RunContext) -> DataFrame:
    """U3 by digest trees: the devices that were added, removed or changed."""
    spark = _spark(t)
    paths = []
    for name, df in zip(("old", "new"), _device_snapshots(t, ctx)):
        paths.append(scratch_path(spark, f"tree-{name}"))
        digest_tree.write_tree(df, paths[-1], DEVICE_KEYS)
    return digest_tree.tree_diff(spark, *paths, DEVICE_KEYS).select("device_eui", "change")


KEPT_RUNS = 4


def _kept_state(t, ctx: RunContext, table: str, key: str, spec: kept_summary.Spec) -> DataFrame:
    """Counters of a table kept over four daily runs. A run knows the contacts up to its
    own time (the last one all of them); its changed rows are merged into a keyed
    store, and only what differs between two versions of that reaches the counters. The
    store holds the columns the counters are made of; a hash of the whole row decides
    between rows of one key."""
    spark = _spark(t)
    store, path = scratch_path(spark, f"kept-{table}"), scratch_path(spark, f"summary-{table}")
    rows, seen = written_once(t, scratch_path(spark, "kept-source"), **{table: t[table]})[table], F.col("last_seen_at")
    before, columns = None, sorted({key, spec.group, spec.seen, *spec.reads})
    for k in range(KEPT_RUNS):
        c = previous_run(ctx, KEPT_RUNS - 1 - k) if k + 1 < KEPT_RUNS else ctx
        known = rows if k + 1 == KEPT_RUNS else rows.withColumn("last_seen_at", F.when(seen <= c.now(), seen))
        batch = known if before is None else known.filter(seen > before.now())
        batch = batch.withColumn("__version", F.lit(k))
        batch = batch.select(*columns, "__version", F.xxhash64(*batch.columns).alias("__whole"))
        keyed_store.merge(spark, store, batch, [key], ["__version", "__whole"], f"{k}.kept")
        names = [n for _, n in keyed_store.versions(spark, store)]
        if before is None:
            kept_summary.start(spark, path, keyed_store.read_store(spark, store), spec, c)
        else:
            changed = keyed_store.changed_rows(spark, store, [key], *names[-2:])
            kept_summary.advance(spark, path, changed, spec, before, c)
        before = c
    return kept_summary.read_state(spark, path)


def kept_device_summary(t, ctx: RunContext) -> DataFrame:
    """Q9 from counters kept by signed deltas."""
    state = _kept_state(t, ctx, "device", "dev_eui", kept_summary.device_spec())
    return device_summary_of(t, ctx, state)


def kept_status_breakdown(t, ctx: RunContext) -> DataFrame:
    """V3 from counters kept by signed deltas."""
    return kept_summary.status_breakdown(_kept_state(t, ctx, "device", "dev_eui", kept_summary.device_spec()))


def kept_gateway_counts(t, ctx: RunContext) -> DataFrame:
    """The counters of Q10 kept by signed deltas, per tenant that has gateways."""
    state = _kept_state(t, ctx, "gateway", "gateway_id", kept_summary.gateway_spec())
    tn = t["tenant"].select("id", F.col("name").alias("tenant_name"))
    return state.join(tn, state["tenant_id"] == tn["id"]).select(
        "tenant_name", state["tenant_id"].cast("string").alias("tenant_id"),
        *[F.col(c).cast("bigint").alias(c) for c in ("total_gateways", "online_gateways", "recent_gateways", "offline_gateways")])


def codec_contents(t, ctx: RunContext) -> DataFrame:
    """Q8b + K8 by content: yesterday's run stores all scripts, today's, in which the
    scripts with an odd number of bytes got another line, stores those; yesterday's
    run is dropped and what only it used is swept. Today's codecs with the run that
    brought their contents, and the contents left in the store."""
    spark = _spark(t)
    root, before = scratch_path(spark, "contents"), previous_run(ctx)
    # of the devices, the codecs need only the profiles they use
    t = written_once(t, scratch_path(spark, "codec-source"), device=t["device"].select("device_profile_id").distinct())
    codec_store.write_run(spark, t, root, before.run_id)
    script = F.col("payload_codec_script")
    edited = t["device_profile"].withColumn("payload_codec_script", F.when(
        non_blank(script) & (F.octet_length(script) % 2 == 1), F.concat(script, F.lit("\n// edited"))).otherwise(script))
    codec_store.write_run(spark, {**{n: t[n] for n in ("device",)}, "device_profile": edited}, root, ctx.run_id)
    snap.delete_paths(spark, [codec_store.refs_path(root, before.run_id)])
    codec_store.sweep(spark, root, [ctx.run_id])
    left = codec_store.read_objects(spark, root).select("digest").distinct().count()
    return codec_store.read_run(spark, root, ctx.run_id).select(
        "codec_file", "digest", "size_bytes", F.length("script").alias("script_chars"), F.lit(left).alias("contents_left"))


def reconciled_servers(t, ctx: RunContext) -> DataFrame:
    """U1 + S11 + S12: the device export of three servers of different versions, written
    below three roots and read by one plan: an older one calls the counter ``fcntup``
    and holds it and the margin in 32 and 16 bits, the oldest has no margin, holds the
    battery in whole percent and the creation as a date."""
    spark = _spark(t)
    d = EXPORTS["devices"].build(t, ctx).select(
        "device_eui", "device_name", "frame_counter_up", "margin", "battery_level", "created_at")
    versions = {
        "current": d,
        "older": d.select("device_eui", "device_name", F.col("frame_counter_up").cast("int").alias("fcntup"),
                          F.col("margin").cast("smallint").alias("Margin"), "battery_level", "created_at"),
        "oldest": d.select("device_name", "device_eui", F.floor("battery_level").cast("int").alias("battery_level"),
                           F.col("frame_counter_up").cast("int").alias("FCntUp"), F.col("created_at").cast("date").alias("created_at")),
    }
    roots = {}
    for name, df in versions.items():
        roots[name] = scratch_path(spark, f"server-{name}")
        df.withColumn("source_server", F.lit(name)).write.parquet(roots[name])
    return reconcile.read_servers(spark, roots, {"frame_counter_up": ["f_cnt_up", "fcntup"]})


def placeholder_union(t, ctx: RunContext) -> DataFrame:
    """The update deployments of a server whose schema has no such table (the
    placeholder with its fixed header) and of one that has."""
    full = EXPORTS["fuota_deployments"].build(t, ctx)
    none = EXPORTS["fuota_deployments"].build({n: t[n] for n in t if n != "fuota_deployment"}, ctx)
    return none.unionByName(full)


def stream_sync(t, ctx: RunContext) -> DataFrame:
    """T1 + K6: yesterday's run is published and synced; then today's is published
    next to one that was written and never published, and synced under a new
    checkpoint, so that both published runs are delivered (again) to a target
    that has versions. The target is returned."""
    spark = _spark(t)
    old, new = _device_snapshots(t, ctx)
    root, target, before = scratch_path(spark, "published"), scratch_path(spark, "target"), previous_run(ctx)
    failed = RunContext(as_of=ctx.as_of + timedelta(hours=1))
    snap.write_snapshot(old, root, "devices", before.run_id, ordered=False)
    snap.publish_current(spark, root, before)
    sync_published(spark, root, "devices", target, DEVICE_KEYS, scratch_path(spark, "stream-ckpt"))
    snap.write_snapshot(new.withColumn("export_timestamp", F.lit(failed.run_id)), root, "devices", failed.run_id, ordered=False)
    snap.write_snapshot(new, root, "devices", ctx.run_id, ordered=False)
    snap.publish_current(spark, root, ctx)
    sync_published(spark, root, "devices", target, DEVICE_KEYS, scratch_path(spark, "stream-ckpt"))
    return read_target(spark, target, old.schema)


LIFECYCLE = {
    "csv_roundtrip": csv_roundtrip,
    "json_roundtrip": json_roundtrip,
    "codec_listing": codec_listing,
    "codec_by_name": codec_by_name,
    "codec_completeness": codec_completeness,
    "archive_current": archive_current,
    "list_exports": list_exports_view,
    "run_stats": run_stats,
    "run_csv": run_csv,
    "run_json": run_json,
    "fetch_export": fetch_export,
    "fetch_codec": fetch_codec,
    "manifest": manifest_view,
    "health": health,
    "current_device_search": current_device_search,
    "current_search_cases": current_search_cases,
    "current_devices_page": current_devices_page,
    "current_device_by_eui": current_device_by_eui,
    "gathered_counts": gathered_counts,
    "export_order": export_order,
    "sync_freshness": sync_freshness,
    "record_counts": record_counts_view,
    "record_totals": record_totals_view,
    "export_run_status": export_run_status,
    "retention": retention,
    "upsert_devices": upsert_devices,
    "snapshot_diff": snapshot_diff,
    "snapshot_changes": snapshot_changes,
    "kept_device_summary": kept_device_summary,
    "kept_status_breakdown": kept_status_breakdown,
    "kept_gateway_counts": kept_gateway_counts,
    "codec_contents": codec_contents,
    "reconciled_servers": reconciled_servers,
    "placeholder_union": placeholder_union,
    "stream_sync": stream_sync,
}

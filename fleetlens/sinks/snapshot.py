"""Sinks and the snapshot lifecycle.

Layout under a shared root (a cluster path, never a machine-local folder):

    archive/<export>/snapshot=<run_id>/part-*    one write-once dataset per export and run
    archive/codec_scripts/snapshot=<run_id>/part-*     the codec dataset of the run
    archive/_metadata/snapshot=<run_id>/part-*.json
    archive/_manifest/snapshot=<run_id>/part-*.json     rows, null counts and key range of every export
    archive_index/pages/snapshot=<run_id>/part-*        the page directory (``sinks.directory``)
    archive_index/search/snapshot=<run_id>/...          the search index of the devices (``sinks.search_index``)
    current/pointer/run_id=<run_id>/part-*.json   written after every export of the run succeeded

Readers resolve "current" as the newest published run, so a run that fails
half-way never replaces good data, and a retried run rewrites only its own
``snapshot=<run_id>`` folders.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.context import RunContext
from fleetlens.plans.exports import EXPORTS, LARGE_EXPORTS, RUN_EXPORTS, codec_files, provenance
from fleetlens.session import PACKED, PACKED_TEXT, dropped_shuffles
from fleetlens.sources.tables import LazyTables, path_exists

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


# ------------------------------------------------------------------ K1, K2

def database_text(df: DataFrame) -> DataFrame:
    """Values as the source database prints them in CSV: booleans ``t``/``f``,
    timestamps without trailing fraction zeros, binary as lower-case hex;
    NULL stays NULL (an empty field, unlike ``''`` which is written ``""``)."""
    cols = []
    for name, dtype in df.dtypes:
        c = F.col(name)
        if dtype == "boolean":
            v = F.when(c, F.lit("t")).when(~c, F.lit("f"))
        elif dtype == "binary":
            v = F.lower(F.hex(c))
        else:
            v = c.cast("string")
        cols.append(v.alias(name))
    return df.select(*cols)


def text_options(compression: str) -> dict[str, str]:
    """Write options of a CSV or JSON form in this compression."""
    return PACKED_TEXT if compression == "gzip" else {"compression": compression}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", as_database_text: bool = False,
              compression: str = "none") -> None:
    """K1: CSV with a header row. NULL is written as an empty field and the
    empty string as ``""``, so both stay distinguishable in the file; spaces
    at the ends of a value are kept. With ``as_database_text`` values are rendered as the source database's CSV
    export renders them. ``compression`` "gzip" packs the files; readers know it by their suffix."""
    out = database_text(df) if as_database_text else df
    (out.write.mode(mode).option("header", True).option("escape", '"').options(**text_options(compression))
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT)
        .csv(path))


def stringly(df: DataFrame) -> DataFrame:
    """K2 value rules of the reference's CSV -> JSON step: every value text,
    NULL -> ``''``, booleans as the database prints them (``t``/``f``)."""
    cols = []
    for name, dtype in df.dtypes:
        c = F.col(name)
        if dtype == "boolean":
            v = F.when(c, F.lit("t")).when(~c, F.lit("f"))
        elif dtype == "binary":
            v = F.lower(F.hex(c))
        else:
            v = c.cast("string")
        cols.append(F.coalesce(v, F.lit("")).alias(name))
    return df.select(*cols)


def write_json(df: DataFrame, path: str, stringly_typed: bool = False, mode: str = "overwrite",
               compression: str = "none") -> None:
    """K2: JSON lines (one object per row, any number of part files)."""
    out = stringly(df) if stringly_typed else df
    (out.write.mode(mode).option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT)
        .option("ignoreNullFields", False).options(**text_options(compression)).json(path))


# ------------------------------------------------------------------ K3, K4

def write_codecs(tables: Mapping, path: str, mode: str = "overwrite", gathered: Gathered | None = None) -> None:
    """K3: every exportable codec script in one job, as a dataset keyed by
    its file name (one parquet file per task, however many codecs). The
    listing and the fetch by name are projections and filters over it. Each file
    is sorted by the name and has Bloom filters of it (S9), without a shuffle."""
    df = codec_files(tables).withColumn("size_bytes", F.octet_length("script") + 1).sortWithinPartitions("codec_file")
    df = gathered.over(df) if gathered else df
    df.write.mode(mode).options(**PACKED, **key_options(["codec_file"])).parquet(path)


def write_codec_files(tables: Mapping, path: str, mode: str = "overwrite") -> None:
    """K3, file form: one text file per codec (the script and a newline), for
    consumers that need loose ``.js`` files. Rows are shuffled by file name
    first so each codec is written by exactly one task. Each file costs a
    commit of its own, so prefer :func:`write_codecs` for large fleets."""
    files = codec_files(tables)
    (files.select("codec_file", "script").repartition("codec_file")
          .write.mode(mode).partitionBy("codec_file").text(path))


def check_codecs(expected: DataFrame, written: DataFrame, key: str = "codec_file") -> DataFrame:
    """K4: expected vs written (non-empty) codec files and how many are
    missing, as one row computed by one aggregate over both sides."""
    w = written.filter(F.col("size_bytes") > 0).select(key).distinct()
    e = expected.select(key).distinct()
    tagged = (e.select(key, F.lit(1).alias("exp"))
               .join(w.select(key, F.lit(1).alias("wr")), key, "full_outer"))
    return tagged.agg(
        F.count("exp").alias("expected_codecs"),
        F.count("wr").alias("written_codecs"),
        F.count(F.when(F.col("exp").isNotNull() & F.col("wr").isNull(), 1)).alias("missing_codecs"))


# ------------------------------------------------------------------ K5 - K12

# Folder of the codec dataset next to the exports (a name without a leading
# underscore: Spark's file listing treats ``_name`` folders as hidden).
CODECS = "codec_scripts"


def codecs_path(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/archive/{CODECS}/snapshot={run_id}"


def snapshot_path(root: str, export: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/archive/{export}/snapshot={run_id}"


def text_path(root: str, form: str, export: str, run_id: str) -> str:
    """Folder of the CSV or JSON form of an export of one run."""
    return f"{root.rstrip('/')}/archive_{form}/{export}/snapshot={run_id}"


def key_options(columns: Iterable[str]) -> dict[str, str]:
    """Parquet write options for looking rows up by these columns: a Bloom filter
    of each per row group, so that a lookup opens the row groups that may hold
    the key and an absent key opens none. The filters are sized by the values
    they get, up to 1 MB a row group."""
    out = {"parquet.bloom.filter.adaptive.enabled": "true"}
    for c in columns:
        out[f"parquet.bloom.filter.enabled#{c}"] = "true"
    return out


class Gathered:
    """K9: rows, NULLs per column and the smallest and largest key of a frame,
    gathered by the job that writes it."""

    def __init__(self, name: str, key: str | None = None):
        self.name, self.key, self.observation = name, key, Observation(f"gathered-{name}")

    def over(self, df: DataFrame) -> DataFrame:
        """``df``, observed. Put it on what is written, behind the sort: a sort's
        sampling job then does not count."""
        self.columns = df.columns
        key = F.col(self.key).cast("string") if self.key else F.lit(None).cast("string")
        nulls = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{i}") for i, c in enumerate(df.columns)]
        return df.observe(self.observation, F.count(F.lit(1)).alias("records"), F.min(key).alias("first_key"),
                          F.max(key).alias("last_key"), *nulls)

    def entry(self) -> dict:
        """The manifest's row, once the frame is written."""
        got = self.observation.get
        nulls = {c: got.get(f"null_{i}", 0) for i, c in enumerate(self.columns)}
        return {"export_name": self.name, "records": got.get("records", 0), "key_column": self.key,
                "first_key": got.get("first_key"), "last_key": got.get("last_key"),
                "null_counts": {c: n for c, n in nulls.items() if n}}


MANIFEST_SCHEMA = ("export_name string, records bigint, key_column string, first_key string, last_key string, "
                   "null_counts map<string, bigint>")


def manifest_path(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/archive/_manifest/snapshot={run_id}"


def run_manifest(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    """What was gathered while a run (default: the current one) was
    written, a row per export; no export is read."""
    rid = run_id or current_run_id(spark, root)
    if rid is None:
        raise FileNotFoundError(f"no published run under {root}")
    return spark.read.schema(MANIFEST_SCHEMA).json(manifest_path(root, rid))


def write_snapshot(df: DataFrame, root: str, export: str, run_id: str, ordered: bool = True,
                   gathered: Gathered | None = None, stamps: Mapping[str, Column] | None = None) -> str:
    """K5: the export of one run, sorted as its file order, as parquet, with Bloom
    filters of its identifying text columns; ``gathered`` takes its counts. ``stamps``: columns
    that have the same value in every row, by name; those it has are put on behind the sort,
    which does not move them."""
    known = EXPORTS.get(export)
    out = df
    if ordered and known:
        out = known.ordered(df.drop(*(stamps or {})))
        out = out.select(*[c if c in out.columns else stamps[c].alias(c) for c in df.columns])
    types = dict(df.dtypes)
    keys = [c for c in (known.unique if known else ()) if types.get(c) == "string"]
    out = gathered.over(out) if gathered else out
    path = snapshot_path(root, export, run_id)
    out.write.mode("overwrite").options(**PACKED, **key_options(keys)).parquet(path)
    return path


def snapshot_metadata(spark: SparkSession, ctx: RunContext, root: str) -> DataFrame:
    """K7: the run's metadata object as a one-row frame."""
    schema = T.StructType([
        T.StructField("server_name", T.StringType()), T.StructField("server_url", T.StringType()),
        T.StructField("export_timestamp", T.StringType()), T.StructField("export_date", T.StringType()),
        T.StructField("archive_path", T.StringType()), T.StructField("api_port", T.IntegerType()),
    ])
    row = (ctx.server_name, ctx.server_url, ctx.run_id, ctx.export_date,
           f"{root.rstrip('/')}/archive", ctx.api_port)
    return spark.createDataFrame([row], schema)


def publish_current(spark: SparkSession, root: str, ctx: RunContext) -> None:
    """K6: record the run as published (metadata + pointer row). Called only
    after every export of the run was written."""
    meta = snapshot_metadata(spark, ctx, root)
    meta.coalesce(1).write.mode("overwrite").json(f"{root.rstrip('/')}/archive/_metadata/snapshot={ctx.run_id}")
    meta.coalesce(1).write.mode("overwrite").json(f"{root.rstrip('/')}/current/pointer/run_id={ctx.run_id}")


def published_runs(spark: SparkSession, root: str) -> DataFrame:
    """Published run ids with their metadata (one small row each)."""
    path = f"{root.rstrip('/')}/current/pointer"
    return (spark.read.option("basePath", path).json(path)
                 .withColumn("run_id", F.col("run_id").cast("string")))


def current_run_id(spark: SparkSession, root: str) -> str | None:
    """The newest published run (max of fixed-width run ids); None only when
    there is no pointer folder yet. Any other storage error is raised."""
    if not path_exists(spark, f"{root.rstrip('/')}/current/pointer"):
        return None
    row = published_runs(spark, root).agg(F.max("run_id").alias("r")).first()
    return row["r"] if row else None


def read_snapshot(spark: SparkSession, root: str, export: str, run_id: str | None = None) -> DataFrame:
    """An export of one run (default: the current one); the run filter
    prunes the other ``snapshot=`` folders."""
    rid = run_id or current_run_id(spark, root)
    if rid is None:
        raise FileNotFoundError(f"no published run under {root}")
    base = f"{root.rstrip('/')}/archive/{export}"
    df = spark.read.option("basePath", base).parquet(snapshot_path(root, export, rid))
    return df.drop("snapshot")


def list_snapshots(spark: SparkSession, root: str, export: str) -> DataFrame:
    """Run ids present in an export's archive: one row per snapshot folder,
    from one listing of the folder names (no files are listed)."""
    names = [p.rsplit("snapshot=", 1)[1] for p in glob_paths(spark, f"{root.rstrip('/')}/archive/{export}/snapshot=*")]
    return spark.createDataFrame([(n,) for n in sorted(names)], "snapshot string")


def expired_snapshots(snapshots: DataFrame, keep: int = 10) -> DataFrame:
    """K8: rank snapshots newest first and flag the ones beyond ``keep``.
    One row per run, so the window over all of them stays tiny."""
    w = Window.orderBy(F.col("snapshot").desc())
    ranked = snapshots.select("snapshot", F.row_number().over(w).alias("rank"))
    return ranked.withColumn("keep", F.col("rank") <= keep)


def delete_paths(spark: SparkSession, paths: Iterable[str]) -> int:
    """Explicit deletion step for expired snapshots (Hadoop file system, so it
    works on any cluster storage)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            fs.delete(path, True)
            n += 1
    return n


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Folders matching a Hadoop glob (names only)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [st.getPath().toString() for st in fs.globStatus(path) or []]


def run_folders(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Run id -> folders of that run under the root (archive, staging,
    pointer), from one glob per layout level (file metadata only)."""
    base = root.rstrip("/")
    out: dict[str, list[str]] = {}
    for pattern, prefix in ((f"{base}/archive/*/snapshot=*", "snapshot="),
                            (f"{base}/archive_csv/*/snapshot=*", "snapshot="),
                            (f"{base}/archive_json/*/snapshot=*", "snapshot="),
                            (f"{base}/archive_index/*/snapshot=*", "snapshot="),
                            (f"{base}/staging/snapshot=*", "snapshot="),
                            (f"{base}/current/pointer/run_id=*", "run_id=")):
        for p in glob_paths(spark, pattern):
            out.setdefault(p.rsplit("/", 1)[1][len(prefix):], []).append(p)
    return out


def record_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """K9: rows per export, all counted in one job (a union of aggregates)."""
    parts = [df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("export_name"), "records")
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def record_totals(counts: DataFrame) -> DataFrame:
    """Total records and number of exports."""
    return counts.agg(F.sum("records").cast("bigint").alias("total_records"),
                      F.count(F.lit(1)).alias("export_count"))


def list_exports(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    """The exports of a run (default: the current one) and its codec
    dataset (as ``codec_scripts``): name, folder, total size, file count and
    last change. Only file metadata is read; the content column of the
    listing is never selected."""
    rid = run_id or current_run_id(spark, root)
    # only this run's folders are listed, however many runs the archive keeps
    folders = [p for p in glob_paths(spark, f"{root.rstrip('/')}/archive/*/snapshot={rid}")
               if not p.rsplit("/", 2)[1].startswith("_")]
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders)
                  .select("path", "length", "modificationTime"))
    rel = F.substring_index(F.col("path"), "/archive/", -1)
    name = F.substring_index(rel, "/", 1)
    leaf = F.substring_index(F.col("path"), "/", -1)
    files = files.filter(rel.contains(f"/snapshot={rid}/") & ~name.startswith("_")
                         & ~leaf.startswith("_") & ~leaf.startswith("."))
    return files.groupBy(name.alias("name")).agg(
        F.sum("length").alias("size"), F.max("modificationTime").alias("modified"),
        F.count(F.lit(1)).alias("files")).withColumn(
        "filename", F.concat(F.col("name"), F.lit(f"/snapshot={rid}")))


def manifest(listing: DataFrame, counts: DataFrame) -> DataFrame:
    """Per export its size, files and record count."""
    return listing.join(counts.withColumnRenamed("export_name", "name"), "name", "left")


@dataclass
class RunResult:
    run_id: str
    status: DataFrame          # K12 rows: export_name, ok, records, error
    published: bool


# Staged tables with one row per device; with ``buckets`` they are written
# bucketed and sorted on the EUI, so their join needs no shuffle. Tables in
# which one device may hold any share of the rows (queue, multicast members,
# relay links) are not bucketed: their joins keep an exchange that AQE can split.
DEVICE_KEYED = {"device": "dev_eui", "device_keys": "dev_eui"}


def stage_table_name(run_id: str, name: str) -> str:
    return f"fleetlens_stage_{run_id}_{name}"


def stage_sources(spark: SparkSession, tables: Mapping, root: str, run_id: str,
                  names: Iterable[str], parallelism: int = 4, buckets: int = 0):
    """Write each source table once for the run and read it back from the
    shared folder. Every export of the run then sees the same snapshot of
    the sources, a slow source (JDBC) is read once instead of once per
    export, and a lost executor re-reads parquet instead of recomputing.
    With ``buckets`` > 0 the device-keyed tables are written as bucketed
    tables (external, in the shared folder) on the device EUI, so the joins
    between them are co-located: sort-merge joins without an exchange."""
    from concurrent.futures import ThreadPoolExecutor
    base = f"{root.rstrip('/')}/staging/snapshot={run_id}"
    names = list(names)
    bucketed = {n for n in names if buckets > 0 and n in DEVICE_KEYED}

    def write(n):
        path = f"{base}/{n}"
        if n in bucketed:
            key = DEVICE_KEYED[n]
            (tables[n].write.mode("overwrite").options(**PACKED).bucketBy(buckets, key).sortBy(key)
                      .option("path", path).saveAsTable(stage_table_name(run_id, n)))
        else:
            tables[n].write.mode("overwrite").options(**PACKED).parquet(path)

    with dropped_shuffles(spark), ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        list(pool.map(write, names))

    def reader(n):
        if n in bucketed:
            return lambda: spark.table(stage_table_name(run_id, n))
        return lambda: spark.read.parquet(f"{base}/{n}")

    staged = {n: reader(n) for n in names}
    rest = {n: (lambda n=n: tables[n]) for n in tables if n not in staged}
    return LazyTables({**rest, **staged})


def drop_stage_tables(spark: SparkSession, run_id: str) -> None:
    """Forget the catalog entries of a run's bucketed staging tables (the
    files stay until retention removes the run)."""
    for n in DEVICE_KEYED:
        spark.sql(f"DROP TABLE IF EXISTS {stage_table_name(run_id, n)}")


# Source tables the run exports read; staged once per run.
RUN_SOURCES = ("tenant", "application", "device_profile", "device", "device_keys", "gateway",
               "user", "tenant_user", "application_integration", "multicast_group",
               "multicast_group_device", "device_queue_item", "api_key", "relay_device", "relay_gateway",
               "fuota_deployment")


def run_exports(spark: SparkSession, tables: Mapping, ctx: RunContext, root: str,
                names: Iterable[str] = RUN_EXPORTS, extra: Mapping | None = None,
                publish: bool = True, with_codecs: bool = True, stage: bool = False,
                parallelism: int = 1, sort_on_write: bool = True, buckets: int = 0,
                formats: Iterable[str] = ("parquet",), indexes: Iterable[str] = ("pages",),
                written: Callable[[str], object] | None = None) -> RunResult:
    """Write every export of a run, each in its own try; a failing
    export is recorded and the run goes on, but the run is only published
    when all of them succeeded. ``stage`` snapshots the sources first (for a
    JDBC source: read once, one consistent view); ``parallelism`` > 1 submits
    that many export jobs at once (each is an independent Spark job, so small
    exports fill the cluster together), of the large exports one after another, so
    that the disk holds the sort of one of them; their CSV forms, which move nothing,
    follow the last sort. ``sort_on_write=False`` skips the
    range sort of each export file: readers page and search with a top-k on
    the same keys, so only consumers of the raw files need the file order.
    ``formats`` adds "csv" and "json" (gzip) next to the parquet of every export,
    made from the written parquet, so an export is computed once. Counts are
    gathered while writing (K9) and kept as the run's manifest. ``indexes``: "pages"
    writes the page directory, "search" the device search index, both of a sorted run.
    ``written`` is called with the name of an export (``CODECS``: the codecs) when its rows
    are written, before its texts and its search index, which are made from these. It may
    be called by several threads at once."""
    from concurrent.futures import ThreadPoolExecutor

    from fleetlens.sinks import directory, search_index

    formats, indexes = tuple(formats), tuple(indexes)
    if path_exists(spark, f"{root.rstrip('/')}/current/pointer/run_id={ctx.run_id}"):
        raise ValueError(f"run {ctx.run_id} is published under {root} and is not written again")
    if stage:
        tables = stage_sources(spark, tables, root, ctx.run_id,
                               [n for n in (*RUN_SOURCES, "server") if n in tables], parallelism, buckets)
    builders = {n: (lambda n=n: EXPORTS[n].build(tables, ctx)) for n in names}
    builders.update(extra or {})
    stamps = provenance(ctx) | provenance(ctx, "report_timestamp")

    def one(name, build):
        """The export's rows, its search index and JSON form."""
        known = EXPORTS.get(name)
        gathered = Gathered(name, known.unique[0] if known and known.unique else None)
        df = build()
        path = write_snapshot(df, root, name, ctx.run_id, ordered=sort_on_write, gathered=gathered,
                              stamps=stamps if name not in (extra or {}) else None)
        if written:
            written(name)
        if name == search_index.EXPORT and sort_on_write and "search" in indexes:  # while the disk holds no texts of it
            index("search", lambda: search_index.write_index(spark, root, ctx.run_id))
        if "json" in formats:
            write_json(spark.read.parquet(path), text_path(root, "json", name, ctx.run_id), stringly_typed=True,
                       compression="gzip")
        return path, gathered, df.schema

    def rest(name, path, gathered, schema):
        """Its CSV form and its entry in the manifest."""
        if "csv" in formats:
            write_csv(spark.read.parquet(path), text_path(root, "csv", name, ctx.run_id), compression="gzip")
        entries.append(gathered.entry())
        schemas[name] = schema
        return entries[-1]["records"]

    def codecs():
        gathered = Gathered(CODECS, "codec_file")
        write_codecs(tables, codecs_path(root, ctx.run_id), gathered=gathered)
        if written:
            written(CODECS)
        entries.append(gathered.entry())
        return entries[-1]["records"]

    def tried(step, *args):
        """(what the step returned, its error): recorded, the run continues."""
        try:
            return step(*args), None
        except Exception as e:  # noqa: BLE001
            return None, f"{type(e).__name__}: {e}"

    def index(name, write):
        try:
            with dropped_shuffles(spark):
                write()
        except Exception as e:  # noqa: BLE001 - recorded; the run is then not published
            failed.append((f"index {name}", False, None, f"{type(e).__name__}: {e}"))

    def ended(name, got, error):
        records, error = (None, error) if error else tried(rest, name, *got)
        status[name] = (name, error is None, records, error)

    def small(name):
        ended(name, *tried(one, name, builders[name]))

    def large_lane():
        for n in large:
            sorted_[n] = tried(one, n, builders[n])

    def codec_lane():
        records, error = tried(codecs)
        codec_rows.append((CODECS, error is None, records, error))

    entries: list[dict] = []
    schemas: dict[str, T.StructType] = {}
    failed: list[tuple] = []
    status: dict[str, tuple] = {}
    codec_rows: list[tuple] = []
    sorted_: dict[str, tuple] = {}
    large = [n for n in LARGE_EXPORTS if n in builders] if parallelism > 1 else []
    jobs = [large_lane, *[lambda n=n: small(n) for n in builders if n not in large], *([codec_lane] if with_codecs else [])]
    with dropped_shuffles(spark):
        if parallelism > 1:
            with ThreadPoolExecutor(max_workers=parallelism) as pool:
                list(pool.map(lambda job: job(), jobs))
                list(pool.map(lambda n: ended(n, *sorted_[n]), reversed(large)))
        else:
            for job in jobs:
                job()
    rows = [status[n] for n in builders] + codec_rows
    if entries:  # a row per export
        (spark.createDataFrame(entries, MANIFEST_SCHEMA).coalesce(1)
         .write.mode("overwrite").json(manifest_path(root, ctx.run_id)))
    known = {n: schemas[n] for n in sorted(schemas) if n in EXPORTS}
    if sort_on_write and known:
        wanted = {"pages": lambda: directory.write_directory(spark, root, ctx.run_id, known),
                  "search": lambda: None}  # written behind the devices
        for name in indexes:
            index(name, lambda name=name: wanted[name]())
    rows += failed
    if stage and buckets > 0:
        drop_stage_tables(spark, ctx.run_id)
    ok = all(r[1] for r in rows)
    if ok and publish:
        publish_current(spark, root, ctx)
    schema = T.StructType([T.StructField("export_name", T.StringType()), T.StructField("ok", T.BooleanType()),
                           T.StructField("records", T.LongType()), T.StructField("error", T.StringType())])
    return RunResult(ctx.run_id, spark.createDataFrame(rows, schema), ok and publish)


def refresh(spark: SparkSession, tables: Mapping, ctx: RunContext, root: str, keep: int = 10,
            stage: bool = False, parallelism: int = 4, sort_on_write: bool = True,
            buckets: int = 0, formats: Iterable[str] = ("parquet", "csv", "json"),
            indexes: Iterable[str] = ("pages", "search")) -> RunResult:
    """The scheduled job: one full run (every export, the codecs),
    publication, then removal of snapshots beyond the newest ``keep``
    published runs. Stage the sources (``stage=True``) when they are read
    over JDBC; file sources are already immutable snapshots and copying them
    every run would rewrite the whole fleet each time."""
    res = run_exports(spark, tables, ctx, root, stage=stage, parallelism=parallelism,
                      sort_on_write=sort_on_write, buckets=buckets, formats=formats, indexes=indexes)
    if res.published:
        runs = published_runs(spark, root).select(F.col("run_id").alias("snapshot"))
        ranked = expired_snapshots(runs, keep).collect()      # one row per published run
        expired = {r["snapshot"] for r in ranked if not r["keep"]}
        published = {r["snapshot"] for r in ranked}
        folders = run_folders(spark, root)
        # runs never published and older than every kept run failed (a run
        # still being written is newer than that): drop them too
        oldest_kept = min(r["snapshot"] for r in ranked if r["keep"])
        failed = {rid for rid in folders if rid not in published and rid < oldest_kept}
        paths = [f"{root.rstrip('/')}/archive/{kind}/snapshot={rid}" for rid in expired for kind in ("_metadata", "_manifest")]
        for rid in expired | failed:
            paths += folders.get(rid, [])
        delete_paths(spark, paths)
    return res

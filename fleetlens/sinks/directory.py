"""Page directory of a run's exports (L3, V7, S10): where the rows of a page lie.

A sorted export is a sequence of files in key order. The directory holds a fence per
file: the rows in it and before it, and its first key. A page by number reads the
files its places fall in; a page behind a key finds the file of the key first. It is
written at publication, from the key columns of the files. Runs written
unsorted have no fences; their pages are cut by a top-k instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetlens.operators.ordering import PageInfo, page_after, page_info, page_rows, rows_after
from fleetlens.plans.exports import EXPORTS
from fleetlens.sources.tables import path_exists

SCHEMA = "export_name string, file string, ordinal int, records bigint, before bigint, first_key string"


def directory_path(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/archive_index/pages/snapshot={run_id}"


def order_keys(name: str) -> list[tuple[str, str]]:
    """Key columns and directions of an export's file order."""
    e = EXPORTS[name]
    return [*e.order, *((c, "asc") for c in e.unique if c not in dict(e.order))]


def fences(spark: SparkSession, root: str, run_id: str, schemas: Mapping[str, StructType]) -> DataFrame:
    """``export_name, file, records, first_key`` of the files of these exports (name and
    schema, so that no file is opened to learn it): rows are
    counted from the files' footers, first keys read in a pass over the key columns."""
    from fleetlens.sinks.snapshot import snapshot_path

    counts, firsts = [], []
    for name, schema in schemas.items():
        df = spark.read.schema(schema).parquet(snapshot_path(root, name, run_id))
        file, keys = F.col("_metadata.file_name").alias("file"), [c for c, _ in order_keys(name)]
        key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}) if keys else F.lit(None).cast("string")
        counts.append(df.select(F.lit(name).alias("export_name"), file))
        firsts.append(df.select(F.lit(name).alias("export_name"), file, key.alias("first_key"),
                                F.col("_metadata.row_index").alias("at")).filter("at = 0").drop("at"))
    records = reduce(DataFrame.unionByName, counts).groupBy("export_name", "file").agg(F.count(F.lit(1)).alias("records"))
    return records.join(reduce(DataFrame.unionByName, firsts), ["export_name", "file"])


def write_directory(spark: SparkSession, root: str, run_id: str, schemas: Mapping[str, StructType]) -> None:
    """The fences of these exports, in one job. File names ascend in key order."""
    every = fences(spark, root, run_id, schemas)
    w = Window.partitionBy("export_name").orderBy("file")  # a row per file
    out = every.select("export_name", "file", (F.row_number().over(w) - 1).alias("ordinal"), "records",
                       (F.sum("records").over(w) - F.col("records")).alias("before"), "first_key")
    out.write.mode("overwrite").parquet(directory_path(root, run_id))


def has_directory(spark: SparkSession, root: str, run_id: str) -> bool:
    return path_exists(spark, f"{directory_path(root, run_id)}/_SUCCESS")


def read_directory(spark: SparkSession, root: str, run_id: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(directory_path(root, run_id)).filter(F.col("export_name") == name)


def placed(spark: SparkSession, root: str, run_id: str, name: str, files: Sequence) -> DataFrame:
    """Rows of these fences' files with ``__place``, their place in the export."""
    from fleetlens.sinks.snapshot import snapshot_path

    base = snapshot_path(root, name, run_id)
    before = F.create_map(*[F.lit(x) for f in files for x in (f["file"], f["before"])])
    df = spark.read.parquet(*[f"{base}/{f['file']}" for f in files])
    return df.withColumn("__place", F.element_at(before, F.col("_metadata.file_name")) + F.col("_metadata.row_index"))


def _empty(spark: SparkSession, root: str, run_id: str, name: str) -> DataFrame:
    from fleetlens.sinks.snapshot import read_snapshot

    return spark.createDataFrame([], read_snapshot(spark, root, name, run_id).schema)


def export_page(spark: SparkSession, root: str, run_id: str, name: str, page=1, limit=100) -> tuple[PageInfo, DataFrame]:
    """One page of an export in its file order: of its files, those that hold the page."""
    from fleetlens.sinks.snapshot import read_snapshot

    if not has_directory(spark, root, run_id):
        df = read_snapshot(spark, root, name, run_id)
        return page_info(df.count(), page, limit), page_rows(df, order_keys(name) or df.columns[:1], page, limit)
    known = read_directory(spark, root, run_id, name)
    info = page_info(known.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0], page, limit)
    start, end = (info.page - 1) * info.limit, info.page * info.limit
    # files of which a page of ``limit`` rows holds at least one: at most ``limit``
    hit = known.filter((F.col("before") < end) & (F.col("before") + F.col("records") > start)).orderBy("ordinal").collect()
    if not hit:
        return info, _empty(spark, root, run_id, name)
    rows = placed(spark, root, run_id, name, hit)
    rows = rows.filter((F.col("__place") >= start) & (F.col("__place") < end))
    return info, rows.orderBy("__place").drop("__place")


def export_page_after(spark: SparkSession, root: str, run_id: str, name: str, after: Mapping | None,
                      limit: int = 100) -> DataFrame:
    """The ``limit`` rows behind a key: from the file the key falls in onwards, as many
    files as hold ``limit`` rows."""
    from fleetlens.sinks.snapshot import read_snapshot

    keys = order_keys(name)
    whole = read_snapshot(spark, root, name, run_id)
    if not has_directory(spark, root, run_id):
        return page_after(whole, keys, after, limit)
    known = read_directory(spark, root, run_id, name)
    if after is not None:
        types = ", ".join(f"{c} {dict(whole.dtypes)[c]}" for c, _ in keys)
        first = known.select("ordinal", F.from_json("first_key", types).alias("k")).select("ordinal", "k.*")
        later = first.filter(rows_after(keys, after)).agg(F.min("ordinal")).first()[0]
        # the file before the first one that begins behind the key is the one the key falls in
        known = known.filter(F.col("ordinal") >= (known.agg(F.max("ordinal")).first()[0] or 0 if later is None else max(later - 1, 0)))
    from_ = known.agg(F.min("before")).first()[0]
    if from_ is None:
        return _empty(spark, root, run_id, name)
    one = known.orderBy("ordinal").limit(1).collect()
    reach = one[0]["before"] + one[0]["records"] + limit
    hit = known.filter(F.col("before") < reach).orderBy("ordinal").collect()  # files of ``limit`` rows and one
    rows = placed(spark, root, run_id, name, hit).drop("__place")
    return page_after(rows, keys, after, limit)

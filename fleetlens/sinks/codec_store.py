"""Codec scripts stored once per content over all runs.

    codec_objects/added=<run_id>/part-*             digest, script: contents first seen in that run
    archive/codec_refs/snapshot=<run_id>/part-*      codec_file, digest, size_bytes of the run

A run writes its references and only the scripts whose digest no earlier run brought,
so a refresh without changes writes no script. Retention marks the digests that the kept
runs refer to and sweeps the others: a folder of which nothing is live is deleted, one
that is live in part is written anew without the rest. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.plans.exports import codec_files
from fleetlens.sources.tables import path_exists

SCHEMA = "digest string, script string"
REFS = "codec_refs"


def objects_path(root: str) -> str:
    return f"{root.rstrip('/')}/codec_objects"


def refs_path(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/archive/{REFS}/snapshot={run_id}"


def read_objects(spark: SparkSession, root: str) -> DataFrame:
    """Stored contents with the folder that holds them (``added``)."""
    if not path_exists(spark, objects_path(root)):
        return spark.createDataFrame([], f"{SCHEMA}, added string")
    return spark.read.schema(f"{SCHEMA}, added string").parquet(objects_path(root))


def write_run(spark: SparkSession, tables: Mapping, root: str, run_id: str) -> int:
    """References of a run and its new scripts; returns the number of new scripts."""
    files = codec_files(tables).select("codec_file", "script", F.sha2("script", 256).alias("digest"))
    refs = files.select("codec_file", "digest", (F.octet_length("script") + 1).alias("size_bytes"))
    # references that this run's own earlier attempt left do not count; its objects are written again
    known = read_objects(spark, root).filter(F.col("added") != run_id).select("digest").distinct()
    # one file per new content; scripts move only for these
    new = refs.groupBy("digest").agg(F.min("codec_file").alias("codec_file")).join(known, "digest", "left_anti").checkpoint()
    n = new.count()
    if n:
        (files.join(new, ["digest", "codec_file"], "left_semi").select("digest", "script")
         .write.mode("overwrite").parquet(f"{objects_path(root)}/added={run_id}"))
    refs.write.mode("overwrite").parquet(refs_path(root, run_id))
    return n


def read_run(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """``codec_file, digest, size_bytes, script`` of a run."""
    refs = spark.read.parquet(refs_path(root, run_id))
    # a content lies in two folders only between the two steps of a sweep
    once = read_objects(spark, root).groupBy("digest").agg(F.min("added").alias("added"))
    objects = read_objects(spark, root).join(once, ["digest", "added"], "left_semi").select("digest", "script")
    return refs.join(objects, "digest").select("codec_file", "digest", "size_bytes", "script")


def sweep(spark: SparkSession, root: str, kept_runs: Iterable[str]) -> dict[str, int]:
    """Remove contents that no kept run refers to. Returns live contents per folder
    that was rewritten or (0) deleted."""
    from fleetlens.sinks.snapshot import delete_paths

    kept = [r for r in kept_runs if path_exists(spark, refs_path(root, r))]
    live = spark.createDataFrame([], "digest string")
    for r in kept:  # a folder per kept run
        live = live.unionByName(spark.read.parquet(refs_path(root, r)).select("digest"))
    live = live.distinct().withColumn("live", F.lit(1))
    objects = read_objects(spark, root)
    marked = objects.select("digest", "added").join(live, "digest", "left")
    folders = marked.groupBy("added").agg(F.count(F.lit(1)).alias("all"), F.count("live").alias("live")).collect()
    out = {}
    for f in folders:  # a row per run that brought contents
        if f["live"] == f["all"]:
            continue
        base = f"{objects_path(root)}/added={f['added']}"
        if f["live"]:
            rest = objects.filter(F.col("added") == f["added"]).join(live, "digest", "left_semi").select("digest", "script")
            rest.write.mode("overwrite").parquet(f"{base}-live")
        delete_paths(spark, [base])
        out[f["added"]] = f["live"]
    return out

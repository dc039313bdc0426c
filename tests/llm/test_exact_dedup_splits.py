"""Rows that stay do not depend on how the files are split from job to job."""

import collections

from fleetlens.llm import common, exact_dedup

SCHEMA = "doc_id long, text string, note string"


def test_splits_that_change_between_the_jobs(spark, monkeypatch):
    rows = [(i, f"only {i}", "a") for i in range(60)] + [(100 + i, f"ONLY {i}", "b") for i in range(0, 60, 3)]
    rows += [(7, "only 7", "again"), (None, "no id", "c"), (None, "no id", "d")]
    path = common.scratch_path(spark, "splits")
    spark.createDataFrame(rows, SCHEMA).repartition(6).write.parquet(path)
    docs = spark.read.parquet(path)
    real, key = exact_dedup.group_index, "spark.sql.files.minPartitionNum"

    def more_cores(digests, shards=None):  # as if executors joined after the digests were written
        spark.conf.set(key, "64")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        return real(digests, shards)
    monkeypatch.setattr(exact_dedup, "group_index", more_cores)
    spark.conf.set(key, "1")
    try:
        assert docs.rdd.getNumPartitions() == 1
        got = exact_dedup.drop_copies(docs).collect()
        assert spark.read.parquet(path).rdd.getNumPartitions() > 6
    finally:
        spark.conf.unset(key)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    texts = collections.Counter(r.text.lower() for r in got)
    assert set(texts) == {r[1].lower() for r in rows} and set(texts.values()) == {1}
    best = {}
    for i, t, _ in rows:
        best[t.lower()] = max(best.get(t.lower(), -1), -1 if i is None else i)
    assert all((-1 if r.doc_id is None else r.doc_id) == best[r.text.lower()] for r in got)

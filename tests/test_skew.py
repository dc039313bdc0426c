"""A hot key (one application with a third of all devices) stays whole and
is split by AQE instead of landing in one task."""

import contextlib
import io

from pyspark.sql import functions as F

from fleetlens.operators.joins import lookup
from fleetlens.plans.exports import device_rollup_by_application
from fleetlens.context import RunContext

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _hot_devices(spark, n=60000):
    # every third device belongs to application 1, the rest spread over 20k
    ids = spark.range(n)
    return ids.select(
        F.col("id").alias("dev_eui"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 20000 + 2).alias("application_id"),
        F.lit(False).alias("is_disabled"), F.lit(None).cast("timestamp_ntz").alias("last_seen_at"),
        (F.col("id") % 100).cast("double").alias("battery_level"), F.lit("A").alias("enabled_class"))


def test_hot_foreign_key_is_split(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        devices = _hot_devices(spark)
        apps = spark.range(0, 20002).select(F.col("id").alias("id"), F.concat(F.lit("app-"), F.col("id")).alias("name"))
        out = lookup(devices, apps, "application_id", "id", {"application_name": "name"})
        rows = out.groupBy("application_name").count().collect()
        assert sum(r["count"] for r in rows) == 60000                      # whole result
        assert dict((r[0], r[1]) for r in rows)["app-1"] == 20000
        joined = lookup(devices, apps, "application_id", "id", {"application_name": "name"})
        joined.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            joined.explain()
        assert "isSkewJoin=true" in buf.getvalue() or "skew=true" in buf.getvalue()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_group_is_combined_map_side(spark):
    devices = _hot_devices(spark)
    agg = device_rollup_by_application(devices, RunContext())
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        agg.explain()
    plan = buf.getvalue()
    # partial aggregation before the exchange: the hot application sends one
    # row per task across the shuffle
    assert plan.count("HashAggregate") >= 2 and "partial_count" in plan
    hot = agg.filter("application_id = 1").first()
    assert hot.total_devices == 20000


def test_bucketed_staging_colocates_device_joins(spark):
    """Staged tables with one row per device are bucketed on the EUI: the
    device join of Q5 runs without an exchange. The queue, in which one device
    may hold any share of the rows, keeps an exchange that AQE can split."""
    from fleetlens.catalog import open_fleet
    from fleetlens.plans.exports import EXPORTS
    from fleetlens.session import scratch_path
    from fleetlens.sinks.snapshot import RUN_SOURCES, drop_stage_tables, stage_sources
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    ctx = RunContext(as_of=__import__("datetime").datetime(2024, 1, 30, 23, 58))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        t = open_fleet(spark, "/root/testdata/sf0.001")
        staged = stage_sources(spark, t, scratch_path(spark, "t-bucket"), "t1", RUN_SOURCES, 4, buckets=4)
        for name in ("devices", "device_queue"):
            df = EXPORTS[name].build(staged, ctx)
            got = sorted(tuple(r) for r in df.collect())
            want = sorted(tuple(r) for r in EXPORTS[name].build(t, ctx).collect())
            assert got == want
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                df.explain()
            final = buf.getvalue().split("== Initial Plan ==")[0]
            if name == "devices":
                assert "Exchange hashpartitioning(dev_eui" not in final
                assert "Exchange hashpartitioning(k_eui" not in final
            else:
                assert "Exchange hashpartitioning(dev_eui" in final
        drop_stage_tables(spark, "t1")
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

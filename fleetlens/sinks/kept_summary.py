"""Summaries kept by signed deltas.

    <path>/state/run=<run_id>             counters per group as of the run
    <path>/events/run=<run_id>/day=<d>    signed changes of counters at known times

A row of the source adds to the counters of its group: static ones by its values, timed
ones by the age of its last contact, which change at times known in advance (a
device seen at ``t`` leaves "seen in 24 h" at ``t + 24 h``). A run reads the rows that
changed since the last one and nothing else of the source: the old row is
subtracted, the new one added, both as of the last run, and their future changes are
written as events with the sign of the row, so those of a subtracted row cancel
out. Then the events between the two runs, found by their day, are added.

An unfinished run leaves a state without ``_SUCCESS``, which is not read, as are
the events of such a run; a retried run writes the same folders again.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.context import RunContext
from fleetlens.sources.tables import path_exists


@dataclass(frozen=True)
class Timed:
    """A counter that depends on a row's age: its value for a row just seen, the steps
    ``(seconds, change, late)`` at which it changes (``late``: just after that time, not
    at it), and its value for a row never seen."""
    start: int
    steps: tuple[tuple[int, int, bool], ...]
    never: int = 0


@dataclass(frozen=True)
class Spec:
    group: str
    seen: str
    static: Mapping[str, Column]
    timed: Mapping[str, Timed] = field(default_factory=dict)
    reads: tuple[str, ...] = ()  # the columns of the source, besides these two, that the counters are made of

    @property
    def counters(self) -> list[str]:
        return [*self.static, *self.timed]


def _flag(pred: Column) -> Column:
    return F.when(pred, 1).otherwise(0)


DAY = 24 * 3600


def device_spec() -> Spec:
    """Counters of the device summary and of the status breakdown, per application."""
    b, disabled = F.col("battery_level"), F.col("is_disabled")
    return Spec("application_id", "last_seen_at", {
        "total_devices": _flag(F.col("dev_eui").isNotNull()),
        "active_devices": _flag(disabled == F.lit(False)), "disabled_devices": _flag(disabled == F.lit(True)),
        "battery_powered_devices": _flag(b.isNotNull()),
        "battery_sum": F.coalesce(b.cast("decimal(20,8)"), F.lit(0).cast("decimal(20,8)")),
        "low_battery_devices": _flag(b < 20),
        "class_a_devices": _flag(F.col("enabled_class") == "A"), "class_b_devices": _flag(F.col("enabled_class") == "B"),
        "class_c_devices": _flag(F.col("enabled_class") == "C"),
        "rows": F.lit(1), "never_seen": _flag(F.col("last_seen_at").isNull()),
    }, {"devices_seen_24h": Timed(1, ((DAY, -1, False),)), "devices_seen_7d": Timed(1, ((7 * DAY, -1, False),))},
           reads=("dev_eui", "battery_level", "is_disabled", "enabled_class"))


def gateway_spec() -> Spec:
    """Counters of the gateway summary, per tenant: exactly one hour old is both recent
    and offline, never seen is offline."""
    return Spec("tenant_id", "last_seen_at", {"total_gateways": _flag(F.col("gateway_id").isNotNull())}, {
        "online_gateways": Timed(1, ((300, -1, False),)),
        "recent_gateways": Timed(0, ((300, 1, False), (3600, -1, True))),
        "offline_gateways": Timed(0, ((3600, 1, False),), never=1)}, reads=("gateway_id",))


def _at(seen: Column, seconds: int, late: bool) -> Column:
    at = seen + F.expr(f"INTERVAL {int(seconds)} SECONDS")
    return at + F.expr("INTERVAL 0.000001 SECONDS") if late else at


def _signed(rows: DataFrame, spec: Spec, ctx: RunContext) -> DataFrame:
    """Counter changes per group of rows with ``__sign``, as of a run."""
    seen, sign = F.col(spec.seen), F.col("__sign")
    cols = [F.sum(sign * v).alias(c) for c, v in spec.static.items()]
    for c, t in spec.timed.items():
        value = F.lit(t.start)
        for seconds, change, late in t.steps:
            value = value + F.when(_at(seen, seconds, late) <= ctx.now(), change).otherwise(0)
        cols.append(F.sum(sign * F.when(seen.isNull(), t.never).otherwise(value)).alias(c))
    return rows.groupBy(spec.group).agg(*cols)


def _events(rows: DataFrame, spec: Spec, ctx: RunContext) -> DataFrame:
    """Future changes of timed counters: ``group, counter, at, change``, summed."""
    seen = F.col(spec.seen)
    each = F.array(*[F.struct(F.lit(c).alias("counter"), _at(seen, s, late).alias("at"),
                              (F.col("__sign") * F.lit(change)).cast("bigint").alias("change"))
                     for c, t in spec.timed.items() for s, change, late in t.steps])
    flat = rows.filter(seen.isNotNull()).select(spec.group, F.inline(each)).filter(F.col("at") > ctx.now())
    return flat.groupBy(spec.group, "counter", "at").agg(F.sum("change").alias("change")).filter("change <> 0")


def _committed(spark: SparkSession, path: str) -> list[str]:
    from fleetlens.sinks.snapshot import glob_paths
    return sorted(p.rsplit("/", 2)[1].split("=", 1)[1] for p in glob_paths(spark, f"{path}/state/run=*/_SUCCESS"))


def read_state(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """Counters per group of a run (default: the newest)."""
    return spark.read.parquet(f"{path}/state/run={run_id or _committed(spark, path)[-1]}")


def _write(spark: SparkSession, path: str, ctx: RunContext, state: DataFrame, events: DataFrame) -> None:
    days = events.withColumn("day", F.date_format("at", "yyyyMMdd").cast("int"))
    days.write.mode("overwrite").partitionBy("day").parquet(f"{path}/events/run={ctx.run_id}")
    state.write.mode("overwrite").parquet(f"{path}/state/run={ctx.run_id}")


def start(spark: SparkSession, path: str, rows: DataFrame, spec: Spec, ctx: RunContext) -> None:
    """The first run: every row is added."""
    all_rows = rows.withColumn("__sign", F.lit(1))
    _write(spark, path, ctx, _signed(all_rows, spec, ctx), _events(all_rows, spec, ctx))


def due(spark: SparkSession, path: str, spec: Spec, before: RunContext, ctx: RunContext) -> DataFrame:
    """Events of committed runs between two runs: only the folders of those days are read."""
    runs = [f"{path}/events/run={r}" for r in _committed(spark, path) if path_exists(spark, f"{path}/events/run={r}")]
    first, last = (int(c.as_of.strftime("%Y%m%d")) for c in (before, ctx))
    ev = spark.read.option("basePath", f"{path}/events").schema(
        f"{spec.group} {_group_type(spark, path, spec)}, counter string, at {ctx.timestamp_type}, change bigint, "
        "run string, day int").parquet(*runs)
    return ev.filter(F.col("day").between(first, last) & (F.col("at") > before.now()) & (F.col("at") <= ctx.now()))


def _group_type(spark: SparkSession, path: str, spec: Spec) -> str:
    return dict(read_state(spark, path).dtypes)[spec.group]


def advance(spark: SparkSession, path: str, changed: DataFrame, spec: Spec, before: RunContext, ctx: RunContext) -> None:
    """The next run from the last one's state: ``changed`` holds ``old`` and ``new``
    (structs; NULL where the row did not or does not exist) of the rows that differ."""
    state = read_state(spark, path, before.run_id)
    signed = (changed.filter("old IS NOT NULL").select("old.*").withColumn("__sign", F.lit(-1))
              .unionByName(changed.filter("new IS NOT NULL").select("new.*").withColumn("__sign", F.lit(1)))).checkpoint()
    passed = due(spark, path, spec, before, ctx)
    expired = passed.groupBy(spec.group).agg(
        *[F.sum(F.when(F.col("counter") == c, F.col("change")).otherwise(0)).alias(c) for c in spec.timed])
    # rows of this run change the counters as of the last run; what falls due since then is added like old events
    fresh = _events(signed, spec, before)
    expired_fresh = fresh.filter(F.col("at") <= ctx.now()).groupBy(spec.group).agg(
        *[F.sum(F.when(F.col("counter") == c, F.col("change")).otherwise(0)).alias(c) for c in spec.timed])
    parts = state.unionByName(_signed(signed, spec, before))
    for more in (expired, expired_fresh):
        parts = parts.unionByName(more, allowMissingColumns=True)
    types = dict(state.dtypes)
    total = parts.groupBy(spec.group).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast(types[c]).alias(c) for c in spec.counters])
    alive = total.filter(F.greatest(*[F.abs(c) for c in spec.counters]) > 0)
    _write(spark, path, ctx, alive, fresh.filter(F.col("at") > ctx.now()))


def status_breakdown(state: DataFrame) -> DataFrame:
    """V3 from the kept counters: devices per activity status, and the disabled ones."""
    total = state.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in
                        ("devices_seen_24h", "devices_seen_7d", "never_seen", "rows", "disabled_devices")])
    seen_week = F.col("devices_seen_7d")
    each = {"Active": F.col("devices_seen_24h"), "Recent": seen_week - F.col("devices_seen_24h"),
            "Never": F.col("never_seen"), "Inactive": F.col("rows") - F.col("never_seen") - seen_week,
            "Disabled": F.col("disabled_devices")}
    pairs = F.array(*[F.struct(F.lit(k).alias("status"), v.alias("count")) for k, v in each.items()])
    return total.select(F.inline(pairs)).filter(F.col("count") > 0)

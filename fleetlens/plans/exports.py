"""The named exports as lazy DataFrame plans.

Each export is ``build(tables, ctx) -> DataFrame`` plus the order its file is
written in. The order is applied by the sink only (one range exchange per
written export); reusable plans stay unsorted so Catalyst can prune and push
filters through them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.context import RunContext
from fleetlens.functions.exprs import (
    codec_filename, deployment_status, device_activity, gateway_connection,
    hex_lower, non_blank, safe_filename, seen_within, text,
)
from fleetlens.operators.aggs import avg_round, bucket_counts, count_when, string_agg
from fleetlens.operators.filters import pending_only
from fleetlens.operators.joins import application_dim, bridge, lookup, lookup_chain, role_join, semi, with_counts
from fleetlens.sources.schema import has_column, has_table, pick_column

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Export:
    name: str
    build: Callable[[Tables, RunContext], DataFrame]
    order: tuple = ()                 # (column, "asc"|"desc") pairs
    description: str = ""
    sensitive: tuple = field(default=())  # key columns restricted by role
    unique: tuple = ()                # columns that identify a row (sort tie-break)

    def ordered(self, df: DataFrame) -> DataFrame:
        """Sort for writing: NULLs last ascending and first descending, the
        order of the source database, then the row's identifying columns.
        The tie-break makes the file order deterministic and lets the range
        exchange split a hot sort value (say, one tenant name on a third of
        all rows) over several tasks instead of one."""
        keys = []
        for c, direction in self.order:
            keys.append(F.col(c).desc_nulls_first() if direction == "desc" else F.col(c).asc_nulls_last())
        keys += [F.col(c).asc_nulls_last() for c in self.unique if c not in dict(self.order)]
        return df.orderBy(*keys) if keys else df


def provenance(ctx: RunContext, ts_name: str = "export_timestamp") -> dict[str, Column]:
    """server and run stamp of every row."""
    return {"source_server": F.lit(ctx.server_name), ts_name: F.lit(ctx.run_id)}


def with_provenance(df: DataFrame, ctx: RunContext, ts_name: str = "export_timestamp") -> DataFrame:
    """add the constant provenance columns (the summaries call the run
    stamp ``report_timestamp``)."""
    return df.withColumns(provenance(ctx, ts_name))


# ---------------------------------------------------------------- Q1, Q7

# The device-class reference table (7 columns, 3 rows).
DEVICE_CLASS_COLUMNS = ("class_name", "description", "power_consumption", "downlink_capability",
                        "typical_latency", "use_cases", "max_devices_recommended")
DEVICE_CLASSES = (
    ("Class A", "Bi-directional end-devices with scheduled uplink", "Lowest (months-years battery)",
     "After uplink only", "Depends on uplink schedule",
     "Battery-powered sensors, periodic monitoring, environmental sensors", "Unlimited"),
    ("Class B", "Bi-directional with scheduled receive slots", "Medium (weeks-months battery)",
     "Scheduled ping slots", "Predictable (configurable)",
     "Actuators, street lighting, smart metering, parking sensors", "10000+"),
    ("Class C", "Bi-directional with continuous receive windows", "Highest (mains-powered)",
     "Nearly continuous", "Very low (<1 second)",
     "Mains-powered devices, critical actuators, emergency systems, alarms", "1000+"),
)


def device_classes(spark: SparkSession) -> DataFrame:
    """The literal device-class table."""
    schema = T.StructType([T.StructField(c, T.StringType(), False) for c in DEVICE_CLASS_COLUMNS])
    return spark.createDataFrame(list(DEVICE_CLASSES), schema)


def _device_classes(t: Tables, ctx: RunContext) -> DataFrame:
    """Q7 with the number of devices per class (A13: zero for unused ones).
    Only the known classes are counted, so the counts have at most three rows
    and that side is broadcast to the 3-row literal it is joined to."""
    spark = t["device"].sparkSession
    known = [c[0].removeprefix("Class ") for c in DEVICE_CLASSES]
    per_class = (t["device"].filter(F.col("enabled_class").isin(known)).groupBy(F.concat(F.lit("Class "), F.col("enabled_class")).alias("cls"))
                 .agg(F.count(F.lit(1)).alias("devices_in_class")))
    classes = device_classes(spark)
    out = classes.join(F.broadcast(per_class), classes["class_name"] == per_class["cls"], "left")
    return out.select(*DEVICE_CLASS_COLUMNS,
                      F.coalesce(F.col("devices_in_class"), F.lit(0).cast("bigint")).alias("devices_in_class"))


def _servers(t: Tables, ctx: RunContext) -> DataFrame:
    """Q1 / S3: server registry, one row per server of the fleet. The id is a
    hash of the name, so a re-run gives the same id."""
    if has_table(t, "server"):
        s = t["server"]
    else:  # one network server: the registry is the run's own server, there is no such table
        s = t["tenant"].sparkSession.createDataFrame([(ctx.server_name,)], "name string")
    return s.select(
        F.sha2(F.col("name"), 256).alias("server_id"),
        F.col("name").alias("server_name"),
        F.concat(F.lit("https://"), F.lower(F.translate(F.col("name"), " ", "-")),
                 F.lit(".example.org")).alias("server_url"),
        F.lit(ctx.environment).alias("environment"),
        F.lit(ctx.export_date).alias("sync_timestamp"),
        F.lit("Active").alias("status"),
        F.lit("Automated export").alias("notes"),
    )


# ---------------------------------------------------------------- Q2 - Q6

def _tenants(t: Tables, ctx: RunContext) -> DataFrame:
    tn = t["tenant"]
    return with_provenance(tn.select(
        text("id").alias("tenant_id"), F.col("name").alias("tenant_name"), "description",
        "max_device_count", "max_gateway_count", "can_have_gateways", "private_gateways_up",
        "private_gateways_down", "created_at", "updated_at"), ctx)


def device_rollup_by_application(device: DataFrame, ctx: RunContext) -> DataFrame:
    """Per application: every device counter the summaries need. Aggregating
    before the join keeps the device table out of any shuffle keyed by a
    (possibly hot) tenant; a hot application costs one partial row per task."""
    b = F.col("battery_level")
    return device.groupBy("application_id").agg(
        F.count("dev_eui").alias("total_devices"),
        count_when(F.col("is_disabled") == F.lit(False)).alias("active_devices"),
        count_when(F.col("is_disabled") == F.lit(True)).alias("disabled_devices"),
        count_when(seen_within(F.col("last_seen_at"), ctx, 24 * 3600)).alias("devices_seen_24h"),
        count_when(seen_within(F.col("last_seen_at"), ctx, 7 * 24 * 3600)).alias("devices_seen_7d"),
        F.count(b).alias("battery_powered_devices"),
        F.sum(b).alias("battery_sum"),
        count_when(b < 20).alias("low_battery_devices"),
        count_when(F.col("enabled_class") == "A").alias("class_a_devices"),
        count_when(F.col("enabled_class") == "B").alias("class_b_devices"),
        count_when(F.col("enabled_class") == "C").alias("class_c_devices"),
    )


DEVICE_COUNTERS = ("total_devices", "active_devices", "disabled_devices", "devices_seen_24h",
                   "devices_seen_7d", "battery_powered_devices", "low_battery_devices",
                   "class_a_devices", "class_b_devices", "class_c_devices")


def device_rollup_by_tenant(t: Tables, ctx: RunContext, per_app: DataFrame | None = None) -> DataFrame:
    """Device counters per tenant id (devices reach a tenant through their
    application; orphans and tenant-less applications drop out). ``per_app``:
    the counters per application if they are kept elsewhere."""
    per_app = device_rollup_by_application(t["device"], ctx) if per_app is None else per_app
    apps = t["application"].select(F.col("id").alias("app_id"), "tenant_id")
    j = per_app.join(apps, per_app["application_id"] == apps["app_id"])
    return j.groupBy("tenant_id").agg(
        *[F.sum(c).alias(c) for c in DEVICE_COUNTERS], F.sum("battery_sum").alias("battery_sum"))


def gateway_rollup_by_tenant(gateway: DataFrame, ctx: RunContext) -> DataFrame:
    ls = F.col("last_seen_at")
    buckets = bucket_counts(ls, ctx)
    return gateway.groupBy("tenant_id").agg(
        F.count("gateway_id").alias("total_gateways"),
        buckets["online"].alias("online_gateways"),
        buckets["recent"].alias("recent_gateways"),
        buckets["offline"].alias("offline_gateways"),
        F.max(ls).alias("last_gateway_activity"),
        F.min(ls).alias("oldest_gateway_activity"),
    )


def _tenants_with_counts(t: Tables, ctx: RunContext) -> DataFrame:
    """Tenants with device and gateway counts, each side aggregated on
    its own and left-joined (J9), missing counts 0."""
    dev = device_rollup_by_tenant(t, ctx).select("tenant_id", "total_devices", "active_devices")
    gw = gateway_rollup_by_tenant(t["gateway"], ctx).select("tenant_id", "total_gateways", "online_gateways")
    j = with_counts(t["tenant"], "id", [(dev, "tenant_id"), (gw, "tenant_id")])
    return with_provenance(j.select(
        text("id").alias("tenant_id"), F.col("name").alias("tenant_name"), "description",
        "max_device_count", "max_gateway_count", "can_have_gateways", "private_gateways_up",
        "private_gateways_down", "created_at", "updated_at",
        "total_devices", "active_devices", "total_gateways", "online_gateways"), ctx)


def _applications(t: Tables, ctx: RunContext) -> DataFrame:
    a = lookup(t["application"], t["tenant"], "tenant_id", "id", {"tenant_name": "name"})
    return with_provenance(a.select(
        text("id").alias("application_id"), F.col("name").alias("application_name"), "description",
        "tenant_name", text("tenant_id").alias("tenant_id"), "created_at", "updated_at"), ctx)


PROFILE_COLUMNS = ("region", "mac_version", "reg_params_revision", "supports_otaa", "supports_class_b",
                   "supports_class_c", "payload_codec_runtime", "uplink_interval",
                   "device_status_req_interval", "rx1_delay", "adr_algorithm_id",
                   "flush_queue_on_activate", "allow_roaming", "auto_detect_measurements",
                   "created_at", "updated_at")


def _device_profiles(t: Tables, ctx: RunContext) -> DataFrame:
    p = lookup(t["device_profile"], t["tenant"], "tenant_id", "id", {"tenant_name": "name"})
    return with_provenance(p.select(
        text("id").alias("profile_id"), F.col("name").alias("profile_name"), "description",
        "tenant_name", text("tenant_id").alias("tenant_id"), *PROFILE_COLUMNS), ctx)


def _devices(t: Tables, ctx: RunContext) -> DataFrame:
    return devices_export(t, ctx)


def device_order_keys(d: DataFrame) -> DataFrame:
    """The device table with its export sort keys (name, then EUI text), so a
    top-k can be taken before any lookup."""
    return d.withColumn("__eui", hex_lower(F.col("dev_eui")))


def only_keys(dim: DataFrame, pk: str, rows: DataFrame, fk: str) -> DataFrame:
    """The dimension rows a small, bounded set of fact rows refers to. The
    fact keys (at most a page of them, a proven bound) are broadcast into a
    semi join, so a large dimension is filtered where it is read instead of
    being shuffled whole to meet a hundred rows."""
    wanted = rows.select(F.col(fk).alias("__want")).filter(F.col("__want").isNotNull()).distinct()
    return dim.join(F.broadcast(wanted), dim[pk] == F.col("__want"), "left_semi")


def devices_export(t: Tables, ctx: RunContext, device: DataFrame | None = None,
                   bounded: bool = False) -> DataFrame:
    """Q5: device + keys + application + profile + tenant. The tenant comes
    from the application (one pre-joined dimension), so an orphan device has
    NULL tenant; the device table meets each dimension once. Every lookup is
    N:1 and keeps the device rows, so a caller may pass ``device`` already
    filtered or cut to a top-k (a page) and only those rows are enriched;
    with ``bounded`` (the rows are a page, of known small size) each
    dimension is first cut to the keys those rows use."""
    rows = _rows_of(t, "devices") if device is None else device_lookups(t, device, bounded)
    return rows.select(*rows.columns, *[v.alias(k) for k, v in provenance(ctx).items()],
                       device_activity(F.col("last_seen_at"), ctx).alias("activity_status"))


def device_lookups(t: Tables, device: DataFrame | None = None, bounded: bool = False) -> DataFrame:
    """Q5 without what depends on the run (its stamps and the activity status)."""
    d = t["device"] if device is None else device
    # older servers call the uplink frame counter ``fcntup``
    frame_counter = pick_column(d, ["f_cnt_up", "fcntup"], default=0)
    dev_keys, application, profiles = t["device_keys"], t["application"], t["device_profile"]
    if bounded and device is not None:
        dev_keys = only_keys(dev_keys, "dev_eui", d, "dev_eui")
        application = only_keys(application, "id", d, "application_id")
        profiles = only_keys(profiles, "id", d, "device_profile_id")
    keys = dev_keys.select(F.col("dev_eui").alias("k_eui"), "app_key", "nwk_key")
    d = d.join(keys, d["dev_eui"] == keys["k_eui"], "left").drop("k_eui")
    apps = application_dim(application, t["tenant"])
    d = lookup(d, apps, "application_id", "app_id",
               {"application_name": "application_name", "app_tenant_id": "app_tenant_id",
                "tenant_name": "tenant_name"})
    d = lookup(d, profiles, "device_profile_id", "id", {"device_profile_name": "name"})
    return d.select(
        hex_lower(F.col("dev_eui")).alias("device_eui"),
        hex_lower(F.col("join_eui")).alias("join_eui"),
        hex_lower(F.col("app_key")).alias("app_key"),
        hex_lower(F.col("nwk_key")).alias("network_key"),
        F.col("name").alias("device_name"), "description", "application_name",
        text("application_id").alias("application_id"), "device_profile_name",
        text("device_profile_id").alias("device_profile_id"), "tenant_name",
        text("app_tenant_id").alias("tenant_id"), "enabled_class", "is_disabled", "skip_fcnt_check",
        "external_power_source", "battery_level", "margin", F.col("dr").alias("data_rate"),
        frame_counter.alias("frame_counter_up"), "latitude", "longitude", "altitude",
        hex_lower(F.col("dev_addr")).alias("device_address"),
        hex_lower(F.col("secondary_dev_addr")).alias("secondary_device_address"),
        "last_seen_at", "created_at", "updated_at",
    )


def _gateways(t: Tables, ctx: RunContext) -> DataFrame:
    g = lookup(t["gateway"], t["tenant"], "tenant_id", "id", {"tenant_name": "name"})
    return g.select(
        hex_lower(F.col("gateway_id")).alias("gateway_eui"), F.col("name").alias("gateway_name"),
        "description", "tenant_name", text("tenant_id").alias("tenant_id"), "latitude", "longitude",
        "altitude", "stats_interval_secs", "last_seen_at", "created_at", "updated_at",
        *[v.alias(k) for k, v in provenance(ctx).items()],
        gateway_connection(F.col("last_seen_at"), ctx).alias("connection_status"),
    )


# ---------------------------------------------------------------- Q8 codecs

def codec_profiles(t: Tables, with_script: bool = True) -> DataFrame:
    """Profiles with a non-blank codec script that at least one device uses,
    with the number of such devices. The device side is reduced to one row
    per profile first; EXISTS is then the inner join with that count.
    Without ``with_script`` the script is replaced by its length (and octet
    length) before the join, so the text never crosses a shuffle."""
    per_profile = (t["device"].filter(F.col("device_profile_id").isNotNull())
                   .groupBy(F.col("device_profile_id").alias("pid"))
                   .agg(F.count("dev_eui").alias("devices_using_profile")))
    p = t["device_profile"].filter(non_blank(F.col("payload_codec_script")))
    if not with_script:
        script = F.col("payload_codec_script")
        p = (p.withColumns({"codec_size_bytes": F.length(script), "script_octets": F.octet_length(script)})
              .drop("payload_codec_script"))
    return p.join(per_profile, p["id"] == per_profile["pid"]).drop("pid")


def _codec_metadata(t: Tables, ctx: RunContext) -> DataFrame:
    """Q8: codec metadata. The script length is computed before the joins, so
    the script text itself never crosses a shuffle."""
    p = codec_profiles(t, with_script=False)
    p = lookup(p, t["tenant"], "tenant_id", "id", {"t_name": "name", "t_id": "id"})
    return with_provenance(p.select(
        text("id").alias("profile_id"), F.col("name").alias("profile_name"),
        F.col("payload_codec_runtime").alias("codec_runtime"), "codec_size_bytes", "description",
        F.col("t_name").alias("tenant_name"), text("t_id").alias("tenant_id"),
        F.col("created_at").alias("codec_created"), F.col("updated_at").alias("codec_updated"),
        F.lit("1.0").alias("codec_version"), "devices_using_profile",
        codec_filename(F.col("name"), F.col("id")).alias("codec_filename")), ctx)


def codec_files(t: Tables) -> DataFrame:
    """One codec file per profile: file name (disk form) and content.
    The file holds the script followed by a newline. EXISTS is a semi join
    against the distinct profile ids of the devices (the distinct combines
    map-side, so a profile used by a third of all devices is one row)."""
    used = t["device"].select("device_profile_id").distinct()
    p = semi(t["device_profile"].filter(non_blank(F.col("payload_codec_script"))), used,
             "id", "device_profile_id")
    return p.select(
        text("id").alias("profile_id"),
        safe_filename(F.col("name"), F.col("id")).alias("codec_file"),
        F.col("payload_codec_script").alias("script"),
    )


def _codec_scripts(t: Tables, ctx: RunContext) -> DataFrame:
    """Q8b as a queryable frame: file name, metadata file name, file size."""
    p = codec_profiles(t, with_script=False)
    return p.select(
        text("id").alias("profile_id"),
        safe_filename(F.col("name"), F.col("id")).alias("codec_file"),
        codec_filename(F.col("name"), F.col("id")).alias("codec_filename"),
        (F.col("script_octets") + 1).alias("file_size_bytes"),
    )


def _codec_count(t: Tables, ctx: RunContext) -> DataFrame:
    """Number of distinct profiles with an exportable codec."""
    return codec_profiles(t, with_script=False).agg(F.count_distinct("id").alias("codec_count"))


# ---------------------------------------------------------------- Q9, Q10

def _device_summary(t: Tables, ctx: RunContext) -> DataFrame:
    """Q9: per tenant device counters (tenant -> application -> device)."""
    return device_summary_of(t, ctx)


def device_summary_of(t: Tables, ctx: RunContext, per_app: DataFrame | None = None) -> DataFrame:
    """Q9, from the device table or from counters kept per application."""
    per_tenant = device_rollup_by_tenant(t, ctx, per_app)
    tn = t["tenant"]
    j = tn.join(per_tenant, tn["id"] == per_tenant["tenant_id"], "left")
    zero = F.lit(0).cast("bigint")
    cnt = {c: F.coalesce(F.col(c), zero) for c in DEVICE_COUNTERS}
    return with_provenance(j.select(
        F.col("name").alias("tenant_name"), text(tn["id"]).alias("tenant_id"),
        *[cnt[c].alias(c) for c in DEVICE_COUNTERS[:6]],
        avg_round(F.col("battery_sum"), F.col("battery_powered_devices")).alias("avg_battery_level"),
        *[cnt[c].alias(c) for c in DEVICE_COUNTERS[6:]]), ctx, "report_timestamp")


def _gateway_summary(t: Tables, ctx: RunContext) -> DataFrame:
    """Q10: per tenant gateway buckets, aggregated before the tenant join."""
    per_tenant = gateway_rollup_by_tenant(t["gateway"], ctx).withColumnRenamed("tenant_id", "gt")
    tn = t["tenant"]
    j = tn.join(per_tenant, tn["id"] == per_tenant["gt"], "left")
    zero = F.lit(0).cast("bigint")
    # A tenant without gateways is one all-NULL row of the reference's LEFT
    # JOIN, and that row satisfies "last_seen_at IS NULL": it reports one
    # offline gateway next to zero total gateways. Kept as is.
    no_gateways = F.col("gt").isNull()
    return with_provenance(j.select(
        F.col("name").alias("tenant_name"), text("id").alias("tenant_id"),
        *[F.coalesce(F.col(c), zero).alias(c) for c in
          ("total_gateways", "online_gateways", "recent_gateways")],
        F.when(no_gateways, F.lit(1).cast("bigint")).otherwise(F.col("offline_gateways"))
         .alias("offline_gateways"),
        "last_gateway_activity", "oldest_gateway_activity"), ctx, "report_timestamp")


# ---------------------------------------------------------------- Q11 - Q20

def _users(t: Tables, ctx: RunContext) -> DataFrame:
    """Q11: users with their tenants as an ordered text list. The bridge is
    aggregated per user first, then joined back (A9: never group by the
    user's attribute columns)."""
    tu = lookup(t["tenant_user"], t["tenant"], "tenant_id", "id", {"t_name": "name", "t_id": "id"})
    per_user = tu.groupBy(F.col("user_id").alias("uid")).agg(
        string_agg("t_name").alias("tenant_access"), F.count("t_id").alias("tenant_count"))
    u = t["user"]
    j = u.join(per_user, u["id"] == per_user["uid"], "left")
    return with_provenance(j.select(
        text("id").alias("user_id"), "email", "is_admin", "is_active", "email_verified", "external_id",
        "note", "created_at", "updated_at", "tenant_access",
        F.coalesce(F.col("tenant_count"), F.lit(0).cast("bigint")).alias("tenant_count")), ctx)


def _tenant_user_roles(t: Tables, ctx: RunContext) -> DataFrame:
    tu = bridge(t["tenant_user"], t["tenant"], "tenant_id", "id", {"tenant_name": "name", "t_id": "id"},
                t["user"], "user_id", "id", {"user_email": "email", "u_id": "id"})
    return with_provenance(tu.select(
        "tenant_name", text("t_id").alias("tenant_id"), "user_email", text("u_id").alias("user_id"),
        F.col("is_admin").alias("is_tenant_admin"), "is_device_admin", "is_gateway_admin",
        "created_at", "updated_at"), ctx)


def _integrations(t: Tables, ctx: RunContext) -> DataFrame:
    apps = application_dim(t["application"], t["tenant"])
    ai = lookup(t["application_integration"], apps, "application_id", "app_id",
                {"a_id": "app_id", "application_name": "application_name", "tenant_name": "tenant_name"})
    return with_provenance(ai.select(
        F.concat(text("a_id"), F.lit("_"), F.col("kind")).alias("integration_id"),
        "application_name", text("a_id").alias("application_id"), "tenant_name",
        F.col("kind").alias("integration_type"), text("configuration").alias("configuration_json"),
        "created_at", "updated_at"), ctx)


def _multicast_groups(t: Tables, ctx: RunContext) -> DataFrame:
    apps = application_dim(t["application"], t["tenant"])
    groups = t["multicast_group"]
    if not has_column(groups, "class_b_ping_slot_periodicity"):  # older schema
        groups = groups.withColumn("class_b_ping_slot_periodicity", F.lit(None).cast("int"))
    mg = lookup(groups, apps, "application_id", "app_id",
                {"application_name": "application_name", "tenant_name": "tenant_name"})
    return with_provenance(mg.select(
        text("id").alias("multicast_group_id"), F.col("name").alias("group_name"),
        text("application_id").alias("application_id"), "application_name", "tenant_name", "region",
        hex_lower(F.col("mc_addr")).alias("multicast_address"),
        hex_lower(F.col("mc_nwk_s_key")).alias("network_session_key"),
        hex_lower(F.col("mc_app_s_key")).alias("application_session_key"),
        F.col("f_cnt").alias("frame_counter"), "group_type", F.col("dr").alias("data_rate"), "frequency",
        "class_b_ping_slot_periodicity", "class_c_scheduling_type"), ctx)


def _multicast_group_devices(t: Tables, ctx: RunContext) -> DataFrame:
    """Q15: bridge rows with group, device and the group's application."""
    return with_provenance(_rows_of(t, "multicast_group_devices"), ctx)


def multicast_lookups(t: Tables) -> DataFrame:
    """Q15 without the run's stamps."""
    apps = application_dim(t["application"], t["tenant"])
    groups = lookup(t["multicast_group"].select("id", "name", "application_id"), apps,
                    "application_id", "app_id",
                    {"application_name": "application_name", "tenant_name": "tenant_name"})
    m = lookup(t["multicast_group_device"], groups, "multicast_group_id", "id",
               {"mg_name": "name", "mg_id": "id", "application_name": "application_name",
                "tenant_name": "tenant_name"})
    m = lookup(m, t["device"], "dev_eui", "dev_eui", {"device_name": "name"})
    return m.select(
        F.col("mg_name").alias("multicast_group_name"), text("mg_id").alias("multicast_group_id"),
        hex_lower(F.col("dev_eui")).alias("device_eui"), "device_name", "application_name",
        "tenant_name", "created_at")


def _device_queue(t: Tables, ctx: RunContext) -> DataFrame:
    """Q16: pending queue items."""
    return with_provenance(_rows_of(t, "device_queue"), ctx)


def queue_lookups(t: Tables) -> DataFrame:
    """Q16 without the run's stamps (the filter runs before any join)."""
    q = pending_only(t["device_queue_item"])
    apps = application_dim(t["application"], t["tenant"])
    q = lookup_chain(q, [
        (t["device"], "dev_eui", "dev_eui", {"device_name": "name", "d_app": "application_id"}),
        (apps, "d_app", "app_id", {"application_name": "application_name", "tenant_name": "tenant_name"}),
    ])
    return q.select(
        text("id").alias("queue_item_id"), hex_lower(F.col("dev_eui")).alias("device_eui"),
        "device_name", F.col("f_port").alias("frame_port"), "confirmed", "is_pending", "is_encrypted",
        F.col("f_cnt_down").alias("frame_counter_down"), "timeout_after", "expires_at", "created_at",
        "application_name", "tenant_name")


def _api_keys(t: Tables, ctx: RunContext) -> DataFrame:
    k = lookup(t["api_key"], t["tenant"], "tenant_id", "id", {"tenant_name": "name"})
    return with_provenance(k.select(
        text("id").alias("api_key_id"), F.col("name").alias("api_key_name"), "is_admin", "tenant_name",
        text("tenant_id").alias("tenant_id"), "created_at"), ctx)


def _relay_devices(t: Tables, ctx: RunContext) -> DataFrame:
    """Q18: relay links with the names of both devices."""
    return with_provenance(_rows_of(t, "relay_devices"), ctx)


def relay_lookups(t: Tables) -> DataFrame:
    """Q18 without the run's stamps: device joined twice, as relay and as relayed device."""
    names = t["device"].select("dev_eui", "name")
    r = role_join(t["relay_device"], names, [("relay_dev_eui", "dev_eui", {"relay_device_name": "name"}),
                                             ("dev_eui", "dev_eui", {"device_name": "name"})])
    return r.select(
        hex_lower(F.col("relay_dev_eui")).alias("relay_device_eui"), "relay_device_name",
        hex_lower(F.col("dev_eui")).alias("device_eui"), "device_name", "created_at")


def _relay_gateways(t: Tables, ctx: RunContext) -> DataFrame:
    g = lookup(t["relay_gateway"], t["tenant"], "tenant_id", "id", {"tenant_name": "name"})
    return g.select(
        hex_lower(F.col("relay_id")).alias("relay_gateway_id"), F.col("name").alias("relay_gateway_name"),
        "description", "tenant_name", text("tenant_id").alias("tenant_id"), "region_config_id",
        "stats_interval_secs", "last_seen_at", "created_at", "updated_at",
        *[v.alias(k) for k, v in provenance(ctx).items()],
        gateway_connection(F.col("last_seen_at"), ctx).alias("connection_status"),
    )


FUOTA_TYPED = ("deployment_id", "deployment_name", "application_name", "application_id",
                 "device_profile_name", "device_profile_id", "tenant_name", "multicast_address",
                 "multicast_group_type", "multicast_class_c_scheduling_type", "data_rate int",
                 "multicast_frequency bigint", "multicast_timeout int", "fragmentation_fragment_size int",
                 "fragmentation_redundancy_percentage int", "request_fragmentation_session_status",
                 "created_at {ts}", "updated_at {ts}", "started_at {ts}", "completed_at {ts}", "deployment_status",
                 "source_server", "export_timestamp")
FUOTA_COLUMNS = tuple(c.split(" ", 1)[0] for c in FUOTA_TYPED)


def _fuota_deployments(t: Tables, ctx: RunContext) -> DataFrame:
    if not has_table(t, "fuota_deployment"):  # S11 probe: older servers have no such table
        from fleetlens.sources.schema import empty_export
        return empty_export(t["tenant"].sparkSession, [c.format(ts=ctx.timestamp_type) for c in FUOTA_TYPED])
    return with_provenance(_rows_of(t, "fuota_deployments"), ctx)


def fuota_lookups(t: Tables) -> DataFrame:
    """Q20 without the run's stamps."""
    apps = application_dim(t["application"], t["tenant"])
    f = lookup(t["fuota_deployment"], apps, "application_id", "app_id",
               {"application_name": "application_name", "tenant_name": "tenant_name"})
    f = lookup(f, t["device_profile"], "device_profile_id", "id", {"device_profile_name": "name"})
    return f.select(
        text("id").alias("deployment_id"), F.col("name").alias("deployment_name"), "application_name",
        text("application_id").alias("application_id"), "device_profile_name",
        text("device_profile_id").alias("device_profile_id"), "tenant_name",
        hex_lower(F.col("multicast_addr")).alias("multicast_address"), "multicast_group_type",
        "multicast_class_c_scheduling_type", F.col("multicast_dr").alias("data_rate"),
        "multicast_frequency", "multicast_timeout", "fragmentation_fragment_size",
        "fragmentation_redundancy_percentage", "request_fragmentation_session_status", "created_at",
        "updated_at", "started_at", "completed_at",
        deployment_status(F.col("started_at"), F.col("completed_at")).alias("deployment_status"))


@dataclass(frozen=True)
class Lookups:
    """The rows of an export without what depends on the run, and the source table that
    nothing but them reads. A caller that exports several runs from the same tables
    gives them as the table ``table``."""
    table: str
    build: Callable[[Tables], DataFrame]
    source: str


#: Exports with a row per device or link of a device. In this order a run sorts last what
#: leaves most for what it moves.
LARGE_EXPORTS: dict[str, Lookups] = {
    "relay_devices": Lookups("relay_lookups", relay_lookups, "relay_device"),
    "multicast_group_devices": Lookups("multicast_lookups", multicast_lookups, "multicast_group_device"),
    "fuota_deployments": Lookups("fuota_lookups", fuota_lookups, "fuota_deployment"),
    "device_queue": Lookups("queue_lookups", queue_lookups, "device_queue_item"),
    "devices": Lookups("device_lookups", device_lookups, "device_keys"),
}


def _rows_of(t: Tables, export: str) -> DataFrame:
    known = LARGE_EXPORTS[export]
    return t[known.table] if has_table(t, known.table) else known.build(t)


# ---------------------------------------------------------------- registry

EXPORTS: dict[str, Export] = {e.name: e for e in (
    Export("servers", _servers, (("server_name", "asc"),), "Q1 server registry", unique=("server_id",)),
    Export("tenants", _tenants, (("tenant_name", "asc"),), "Q2", unique=("tenant_id",)),
    Export("tenants_with_counts", _tenants_with_counts, (("tenant_name", "asc"),), "Q2b",
           unique=("tenant_id",)),
    Export("applications", _applications, (("application_name", "asc"),), "Q3",
           unique=("application_id",)),
    Export("device_profiles", _device_profiles, (("profile_name", "asc"),), "Q4", unique=("profile_id",)),
    Export("devices", _devices, (("device_name", "asc"),), "Q5", ("app_key", "network_key"),
           unique=("device_eui",)),
    Export("gateways", _gateways, (("gateway_name", "asc"),), "Q6", unique=("gateway_eui",)),
    Export("device_classes", _device_classes, (("class_name", "asc"),), "Q7"),
    Export("payload_codecs_metadata", _codec_metadata, (("tenant_name", "asc"), ("profile_name", "asc")), "Q8",
           unique=("profile_id",)),
    Export("codec_scripts", _codec_scripts, (("codec_file", "asc"),), "Q8b", unique=("profile_id",)),
    Export("codec_count", _codec_count, (), "Q8c"),
    Export("device_summary", _device_summary, (("tenant_name", "asc"),), "Q9", unique=("tenant_id",)),
    Export("gateway_summary", _gateway_summary, (("tenant_name", "asc"),), "Q10", unique=("tenant_id",)),
    Export("users", _users, (("email", "asc"),), "Q11", unique=("user_id",)),
    Export("tenant_user_roles", _tenant_user_roles, (("tenant_name", "asc"), ("user_email", "asc")), "Q12",
           unique=("tenant_id", "user_id")),
    Export("integrations", _integrations, (("application_name", "asc"), ("integration_type", "asc")),
           "Q13", ("configuration_json",),
           unique=("application_id", "created_at", "updated_at", "configuration_json")),
    Export("multicast_groups", _multicast_groups, (("group_name", "asc"),), "Q14",
           ("network_session_key", "application_session_key"), unique=("multicast_group_id",)),
    Export("multicast_group_devices", _multicast_group_devices,
           (("multicast_group_name", "asc"), ("device_name", "asc")), "Q15",
           unique=("multicast_group_id", "device_eui")),
    Export("device_queue", _device_queue, (("created_at", "desc"),), "Q16", unique=("queue_item_id",)),
    Export("api_keys", _api_keys, (("api_key_name", "asc"),), "Q17", unique=("api_key_id",)),
    Export("relay_devices", _relay_devices, (("relay_device_name", "asc"), ("device_name", "asc")), "Q18",
           unique=("relay_device_eui", "device_eui")),
    Export("relay_gateways", _relay_gateways, (("relay_gateway_name", "asc"),), "Q19",
           unique=("relay_gateway_id",)),
    Export("fuota_deployments", _fuota_deployments, (("created_at", "desc"),), "Q20",
           unique=("deployment_id",)),
)}

# Exports a full run writes, in the reference's order (the codec count and
# the tenants-with-counts variant are extra queries, not files).
RUN_EXPORTS = ("servers", "tenants", "applications", "device_profiles", "devices", "gateways",
               "device_classes", "payload_codecs_metadata", "device_summary", "gateway_summary",
               "users", "tenant_user_roles", "integrations", "multicast_groups",
               "multicast_group_devices", "device_queue", "api_keys", "relay_devices",
               "relay_gateways", "fuota_deployments")


def build_export(name: str, tables: Tables, ctx: RunContext) -> DataFrame:
    """S10 without the count: the export's lazy plan; unknown names raise."""
    if name not in EXPORTS:
        raise KeyError(f"unknown export: {name}")
    return EXPORTS[name].build(tables, ctx)

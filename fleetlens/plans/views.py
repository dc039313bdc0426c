"""Read-side queries of the portal.

Views are planned on the smallest input that gives the same rows: a status
breakdown reads the device table with its status expression, not the full
device export with its four lookups (Catalyst cannot drop a left join whose
columns go unused).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.context import RunContext
from fleetlens.functions.exprs import (
    age_label, badge, device_activity, gateway_connection, hex_lower, page_count, parse_long,
    seen_within, text,
)
from fleetlens.operators.aggs import breakdown, by_server, child_counts, count_when
from fleetlens.operators.filters import (
    active_servers, by_id, device_filter, filter_status, gateway_map, low_battery, restrict, search,
)
from fleetlens.operators.joins import application_dim, lookup, orphans
from fleetlens.operators.ordering import page_numbers, page_rows, preview, top_tenants
from fleetlens.plans.exports import (
    EXPORTS, RUN_EXPORTS, codec_profiles, device_order_keys, devices_export, only_keys,
)
from fleetlens.sinks.snapshot import record_counts
from fleetlens.sources.schema import pick_column

Tables = dict


def _export(name: str, t: Tables, ctx: RunContext) -> DataFrame:
    return EXPORTS[name].build(t, ctx)


def device_status_frame(t: Tables, ctx: RunContext) -> DataFrame:
    d = t["device"]
    return d.select("dev_eui", "name", "application_id", "device_profile_id", "is_disabled",
                    "battery_level", "enabled_class", "last_seen_at",
                    device_activity(F.col("last_seen_at"), ctx).alias("activity_status"))


def gateway_status_frame(t: Tables, ctx: RunContext) -> DataFrame:
    g = t["gateway"]
    return g.select("gateway_id", "name", "tenant_id", "latitude", "longitude", "last_seen_at",
                    gateway_connection(F.col("last_seen_at"), ctx).alias("connection_status"))


def _kpi_union(t: Tables, ctx: RunContext) -> DataFrame:
    """Inputs of the one-row KPI frames, stacked so one aggregate computes all
    of them (no join between single-row aggregates)."""
    ds = _export("device_summary", t, ctx).select(
        F.lit(1).alias("tenants"), "total_devices", "active_devices", "devices_seen_24h")
    gs = _export("gateway_summary", t, ctx).select("total_gateways", "online_gateways")
    codecs = codec_profiles(t, with_script=False).select(F.lit(1).alias("codecs"))
    servers = t["server"].select(F.lit(1).alias("servers"))
    out = ds
    for part in (gs, codecs, servers):
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def _sum0(c: str):
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def stats(t: Tables, ctx: RunContext) -> DataFrame:
    """V1: server, last export, number of exports and codecs, summary totals."""
    return _kpi_union(t, ctx).agg(
        F.lit(ctx.server_name).alias("server_name"), F.lit(ctx.export_date).alias("last_export"),
        F.lit(len(RUN_EXPORTS)).cast("bigint").alias("exports_available"),
        _sum0("codecs").alias("codecs_available"), _sum0("tenants").alias("tenants"),
        _sum0("total_devices").alias("total_devices"), _sum0("active_devices").alias("active_devices"),
        _sum0("total_gateways").alias("total_gateways"), _sum0("online_gateways").alias("online_gateways"))


def dashboard_kpis(t: Tables, ctx: RunContext) -> DataFrame:
    """V2: the dashboard's KPI cards as one row."""
    return _kpi_union(t, ctx).agg(
        _sum0("tenants").alias("tenants"), _sum0("total_devices").alias("total_devices"),
        _sum0("online_gateways").alias("online_gateways"),
        _sum0("devices_seen_24h").alias("active_devices_24h"), _sum0("codecs").alias("codecs_available"),
        F.lit(ctx.export_date).alias("last_export"), _sum0("servers").alias("servers"))


def device_status_breakdown(t: Tables, ctx: RunContext) -> DataFrame:
    """V3: devices per activity status, and the disabled ones (whatever their
    activity) as the dashboard's fifth figure."""
    d = device_status_frame(t, ctx)
    status = F.array(F.coalesce("activity_status", F.lit("Unknown")),
                     F.when(F.col("is_disabled"), F.lit("Disabled")))
    return (d.select(F.explode(F.array_compact(status)).alias("status"))
            .groupBy("status").agg(F.count(F.lit(1)).alias("count")))


def gateway_status_breakdown(t: Tables, ctx: RunContext) -> DataFrame:
    """V4: gateways per connection status."""
    return breakdown(gateway_status_frame(t, ctx), "connection_status")


def devices_per_tenant(t: Tables, ctx: RunContext) -> DataFrame:
    """V5: tenants ranked by number of devices."""
    return top_tenants(_export("device_summary", t, ctx))


SEARCH_COLUMNS = ("device_name", "device_eui", "application_name")


def device_search_frame(t: Tables, ctx: RunContext) -> DataFrame:
    """The columns the device search needs: the device table with its
    application name (one lookup instead of the full export)."""
    d = t["device"].select("dev_eui", "name", "application_id", "last_seen_at", "battery_level",
                           "is_disabled")
    d = lookup(d, t["application"], "application_id", "id", {"application_name": "name"})
    return d.select(hex_lower(F.col("dev_eui")).alias("device_eui"), F.col("name").alias("device_name"),
                    "application_name", text("application_id").alias("application_id"),
                    "battery_level", "is_disabled",
                    device_activity(F.col("last_seen_at"), ctx).alias("activity_status"))


def device_search(t: Tables, ctx: RunContext, q: str = "42", cap: int = 100) -> DataFrame:
    """V6: matches of ``q`` (first ``cap`` by name) with the total count.

    Same rows as searching :func:`device_search_frame`, planned so that the
    device table is never joined whole with the applications: the
    application-name test is evaluated on the application table, and devices
    are only flagged against the applications that matched (usually few, so
    AQE broadcasts them). Names are looked up for the ``cap`` result rows
    only, against the applications those rows use."""
    needle = (q or "").lower()

    def has(c):
        return F.coalesce(F.lower(c).contains(F.lit(needle)), F.lit(False))

    apps = t["application"]
    hit_apps = apps.filter(has(F.col("name"))).select(F.col("id").alias("__hit_app"))
    d = t["device"].select(hex_lower(F.col("dev_eui")).alias("device_eui"), F.col("name").alias("device_name"),
                           "application_id", "last_seen_at", "battery_level", "is_disabled")
    flagged = d.join(hit_apps, d["application_id"] == hit_apps["__hit_app"], "left")
    matches = flagged.filter(has(F.col("device_name")) | has(F.col("device_eui"))
                             | F.col("__hit_app").isNotNull()).drop("__hit_app")
    total = matches.count()
    # the result rows (at most ``cap``) are written once to the shared
    # checkpoint folder and read by both the name lookup and the output
    top = (matches.orderBy(F.col("device_name").asc_nulls_last(), F.col("device_eui").asc_nulls_last())
                  .limit(cap).checkpoint())
    named = lookup(top, only_keys(apps, "id", top, "application_id"), "application_id", "id",
                   {"application_name": "name"})
    rows = named.select("device_eui", "device_name", "application_name",
                        text("application_id").alias("application_id"), "battery_level", "is_disabled",
                        device_activity(F.col("last_seen_at"), ctx).alias("activity_status"))
    rows = rows.orderBy(F.col("device_name").asc_nulls_last(), F.col("device_eui").asc_nulls_last())
    return rows.withColumns({"query": F.lit(needle), "match_count": F.lit(total).cast("bigint")})


def devices_page(t: Tables, ctx: RunContext, page=3, limit=100) -> DataFrame:
    """V7: one page of the device export in file order. The page is cut from
    the device table first (a top-k on name and EUI, the export's sort keys)
    and only its rows go through the lookups, instead of joining every device
    and then keeping a hundred."""
    keyed = device_order_keys(t["device"])
    # the cut (at most ``limit`` rows) is written once to the shared checkpoint
    # folder: every lookup below reads it instead of rescanning the devices
    cut = page_rows(keyed, ["name", "__eui"], page, limit).drop("__eui").checkpoint()
    return page_rows(devices_export(t, ctx, cut, bounded=True), ["device_name", "device_eui"], 1, limit)


def page_walk(t: Tables, ctx: RunContext, limit: int = 500) -> DataFrame:
    """L3: every device with the number of its page, numbered in one sort on
    Spark. Single deep pages are cut by keyset (``page_after``)."""
    keyed = device_order_keys(t["device"]).select("name", "__eui")
    out = page_numbers(keyed, ["name", "__eui"], limit)
    return out.select(F.lower(F.col("__eui")).alias("device_eui"), F.col("name").alias("device_name"), "page")


def page_metadata(t: Tables, ctx: RunContext, page=3, limit=100) -> DataFrame:
    """L3 metadata of one page of every export: total, pages and neighbours."""
    counts = record_counts({n: _export(n, t, ctx) for n in RUN_EXPORTS})
    info = F.ceil(F.col("records") / limit)
    return counts.select(
        "export_name", F.col("records").alias("total"), F.lit(page).alias("page"), F.lit(limit).alias("page_limit"),
        info.alias("total_pages"), F.when(F.col("records") > page * limit, F.lit(page + 1)).alias("next_page"),
        F.when(F.lit(page) > 1, F.lit(page - 1)).alias("previous_page"))


def online_gateways(t: Tables, ctx: RunContext) -> DataFrame:
    """V8: gateways whose status is Online."""
    return filter_status(_export("gateways", t, ctx), "connection_status", "Online")


def active_device_count(t: Tables, ctx: RunContext) -> DataFrame:
    """V8: number of devices with status Active."""
    d = device_status_frame(t, ctx)
    return d.agg(count_when(F.col("activity_status") == "Active").alias("active_device_count"))


def device_quick_stats(t: Tables, ctx: RunContext) -> DataFrame:
    """V9: total, active (24 h), seen in 7 days, class A, low battery."""
    d = t["device"]
    ls = F.col("last_seen_at")
    return d.agg(
        F.count(F.lit(1)).alias("total"),
        count_when(seen_within(ls, ctx, 24 * 3600)).alias("active_24h"),
        count_when(seen_within(ls, ctx, 7 * 24 * 3600)).alias("recent_7d"),
        count_when(F.col("enabled_class") == "A").alias("class_a"),
        count_when(F.col("battery_level") < 20).alias("low_battery"),
        count_when(F.col("is_disabled") == F.lit(True)).alias("disabled"))


def tenant_cards(t: Tables, ctx: RunContext) -> DataFrame:
    """Tenant with device and gateway counts."""
    return _export("tenants_with_counts", t, ctx).select(
        "tenant_id", "tenant_name", "source_server", F.col("total_devices").alias("device_count"),
        F.col("total_gateways").alias("gateway_count"))


def application_cards(t: Tables, ctx: RunContext) -> DataFrame:
    """Applications with their number of devices, zero included."""
    apps = lookup(t["application"], t["tenant"], "tenant_id", "id", {"tenant_name": "name"})
    c = child_counts(apps.select("id", "name", "tenant_name"), "id", t["device"], "application_id",
                     "device_count")
    return c.select(text("id").alias("application_id"), F.col("name").alias("application_name"),
                    "tenant_name", "device_count")


def profile_cards(t: Tables, ctx: RunContext) -> DataFrame:
    """Device profiles with their number of devices, zero included."""
    c = child_counts(t["device_profile"].select("id", "name"), "id", t["device"], "device_profile_id",
                     "device_count")
    return c.select(text("id").alias("profile_id"), F.col("name").alias("profile_name"), "device_count")


def low_battery_devices(t: Tables, ctx: RunContext) -> DataFrame:
    """Devices with battery below 20 and where they belong."""
    d = low_battery(t["device"])
    apps = application_dim(t["application"], t["tenant"])
    d = lookup(d, apps, "application_id", "app_id",
               {"application_name": "application_name", "tenant_name": "tenant_name"})
    return d.select(hex_lower(F.col("dev_eui")).alias("device_eui"), F.col("name").alias("device_name"),
                    "battery_level", "application_name", "tenant_name",
                    device_activity(F.col("last_seen_at"), ctx).alias("activity_status"))


def gateway_map_view(t: Tables, ctx: RunContext) -> DataFrame:
    """Located gateways for the map."""
    return gateway_map(_export("gateways", t, ctx), ctx)


def permissions_matrix(t: Tables, ctx: RunContext) -> DataFrame:
    """User x tenant with the three role flags."""
    return _export("tenant_user_roles", t, ctx).select(
        "user_email", "user_id", "tenant_name", "tenant_id", "is_tenant_admin", "is_device_admin",
        "is_gateway_admin")


# ----------------------------------------------------------- §7.6 extras

def device_filters(t: Tables, ctx: RunContext, tenant: str = "NATION_1") -> DataFrame:
    """active devices of one tenant (tenant from the application)."""
    d = t["device"].select("dev_eui", "name", "application_id", "is_disabled")
    apps = application_dim(t["application"], t["tenant"])
    d = lookup(d, apps, "application_id", "app_id",
               {"application_name": "application_name", "tenant_name": "tenant_name"})
    d = device_filter(d, active_only=True, tenant=tenant)
    return d.select(hex_lower(F.col("dev_eui")).alias("device_eui"), F.col("name").alias("device_name"),
                    "application_name", "tenant_name")


def active_servers_view(t: Tables, ctx: RunContext) -> DataFrame:
    """F12."""
    return active_servers(_export("servers", t, ctx))


def restricted_devices(t: Tables, ctx: RunContext, role: str = "viewer") -> DataFrame:
    """device export as a non-admin sees it."""
    return restrict(_export("devices", t, ctx), role)


# One row per foreign key of the schema: (child, fk, parent, pk).
FOREIGN_KEYS = (
    ("application", "tenant_id", "tenant", "id"),
    ("device_profile", "tenant_id", "tenant", "id"),
    ("device", "application_id", "application", "id"),
    ("device", "device_profile_id", "device_profile", "id"),
    ("device_keys", "dev_eui", "device", "dev_eui"),
    ("gateway", "tenant_id", "tenant", "id"),
    ("tenant_user", "tenant_id", "tenant", "id"),
    ("tenant_user", "user_id", "user", "id"),
    ("application_integration", "application_id", "application", "id"),
    ("multicast_group", "application_id", "application", "id"),
    ("multicast_group_device", "multicast_group_id", "multicast_group", "id"),
    ("multicast_group_device", "dev_eui", "device", "dev_eui"),
    ("device_queue_item", "dev_eui", "device", "dev_eui"),
    ("api_key", "tenant_id", "tenant", "id"),
    ("relay_device", "relay_dev_eui", "device", "dev_eui"),
    ("relay_device", "dev_eui", "device", "dev_eui"),
    ("relay_gateway", "tenant_id", "tenant", "id"),
    ("fuota_deployment", "application_id", "application", "id"),
    ("fuota_deployment", "device_profile_id", "device_profile", "id"),
)


def orphan_devices(t: Tables, ctx: RunContext) -> DataFrame:
    """Devices whose application does not exist."""
    o = orphans(t["device"], t["application"], "application_id", "id")
    return o.select(hex_lower(F.col("dev_eui")).alias("device_eui"), F.col("name").alias("device_name"),
                    text("application_id").alias("application_id"))


def orphan_report(t: Tables, ctx: RunContext) -> DataFrame:
    """J11 for every foreign key: number of child rows without a parent.
    Each child is first counted per key value (combined within the tasks, so a
    hot key is one row per task; the child is a number there, its names are added to
    the totals); the counts of all children of one parent meet it in a single anti
    join, so each parent table is read once. Foreign keys without any orphan report 0."""
    by_parent: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for child, fk, parent, pk in FOREIGN_KEYS:
        by_parent.setdefault((parent, pk), []).append((child, fk))
    parts = []
    for (parent, pk), children in by_parent.items():
        ptype = dict(t[parent].dtypes)[pk]
        refs = None
        for i, (child, fk) in enumerate(children):
            r = t[child].select(F.col(fk).cast(ptype).alias("ref"), F.lit(i).alias("child")).filter("ref IS NOT NULL")
            refs = r if refs is None else refs.unionByName(r)
        per_key = refs.groupBy("ref", "child").agg(F.count(F.lit(1)).alias("n"))
        missing = orphans(per_key, t[parent], "ref", pk)
        counts = missing.groupBy("child").agg(F.sum("n").alias("orphan_rows"))
        named = F.array(*[F.struct(F.lit(child).alias("child_table"), F.lit(fk).alias("foreign_key")) for child, fk in children])
        parts.append(counts.select(F.get(named, F.col("child")).alias("names"), "orphan_rows").select("names.*", "orphan_rows"))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    spark = t["tenant"].sparkSession
    every = spark.createDataFrame([(c, fk, p) for c, fk, p, _ in FOREIGN_KEYS],
                                  "child_table string, foreign_key string, parent_table string")
    # ``found`` has at most one row per foreign key of the fixed list: bounded
    out = every.join(F.broadcast(found), ["child_table", "foreign_key"], "left")
    return out.select("child_table", "foreign_key", "parent_table",
                      F.coalesce(F.col("orphan_rows"), F.lit(0).cast("bigint")).alias("orphan_rows"))


def preview_devices(t: Tables, ctx: RunContext, n: int = 10) -> DataFrame:
    """The first rows of the device export by device EUI (top-k on the
    device table, then the lookups for those rows only)."""
    cut = preview(device_order_keys(t["device"]), ["__eui"], n).drop("__eui").checkpoint()
    return preview(devices_export(t, ctx, cut, bounded=True), ["device_eui"], n)


NO_SERVER = "unassigned"


def combined_servers(t: Tables, ctx: RunContext) -> DataFrame:
    """The application export of every server in one frame, keyed by
    (source_server, application_id). The server is a column reached by one
    left join application -> tenant -> server; applications whose tenant or
    server is missing stay, under the server ``unassigned``. Exports that
    really come from different roots are stacked by ``combine_servers``."""
    servers = lookup(t["tenant"].select("id", "server_id"), t["server"], "server_id", "id", {"server": "name"})
    tagged = lookup(t["application"].select("id", "tenant_id"), servers, "tenant_id", "id", {"server": "server"})
    apps = _export("applications", t, ctx)
    tags = tagged.select(text("id").alias("__app"), F.col("server").alias("__server"))
    return (apps.join(tags, apps["application_id"] == tags["__app"], "left")
            .withColumn("source_server", F.coalesce(F.col("__server"), F.lit(NO_SERVER)))
            .select(*apps.columns))


def rows_by_server(t: Tables, ctx: RunContext) -> DataFrame:
    """Rows per source server of the combined application export."""
    return by_server(combined_servers(t, ctx))


def age_labels(t: Tables, ctx: RunContext) -> DataFrame:
    """C14: relative age of every gateway's last contact."""
    g = t["gateway"]
    return g.select(hex_lower(F.col("gateway_id")).alias("gateway_eui"), "last_seen_at",
                    age_label(F.col("last_seen_at"), ctx).alias("age_label"))


def badges(t: Tables, ctx: RunContext) -> DataFrame:
    """Badge colour per device status, with counts."""
    d = device_status_frame(t, ctx)
    return (d.groupBy("activity_status").agg(F.count(F.lit(1)).alias("devices"))
             .withColumn("badge", badge(F.col("activity_status"))))


def numeric_parse(t: Tables, ctx: RunContext) -> DataFrame:
    """Summary counters as the read API delivers them (text) parsed back
    to numbers; an empty or malformed field gives NULL."""
    ds = _export("device_summary", t, ctx)
    as_text = ds.select("tenant_id", F.coalesce(text("total_devices"), F.lit("")).alias("total_devices_text"),
                        F.coalesce(text("avg_battery_level"), F.lit("")).alias("avg_battery_text"))
    return as_text.select("tenant_id", parse_long(F.col("total_devices_text")).alias("total_devices"),
                          parse_long(F.col("avg_battery_text")).alias("avg_battery_whole"))


def page_counts(t: Tables, ctx: RunContext, limits=(1, 7, 100, 1000)) -> DataFrame:
    """C17: number of pages of the device export for several page sizes; the
    devices are counted once."""
    total = t["device"].agg(F.count(F.lit(1)).alias("total"))
    each = F.array(*[F.struct(F.lit(n).alias("page_limit"), page_count(F.col("total"), n).alias("total_pages")) for n in limits])
    return total.select("total", F.inline(each)).select("page_limit", "total", "total_pages")


def column_fallback(t: Tables, ctx: RunContext) -> DataFrame:
    """The frame counter picked from the current schema and from an
    older one where the column is called ``fcntup`` (NULL -> 0)."""
    names = ["f_cnt_up", "fcntup"]
    new = t["device"].select(hex_lower(F.col("dev_eui")).alias("device_eui"), "f_cnt_up")
    new = new.withColumn("frame_counter_up", pick_column(new, names))
    old = new.withColumnRenamed("f_cnt_up", "fcntup")
    return old.select("device_eui", "frame_counter_up", pick_column(old, names).alias("frame_counter_up_old_schema"))


def device_by_eui(t: Tables, ctx: RunContext) -> DataFrame:
    """the device with the smallest EUI, fetched by it; the key filter
    reaches the device table before any lookup."""
    keyed = device_order_keys(t["device"])
    first = keyed.agg(F.min("__eui")).first()[0]
    return devices_export(t, ctx, by_id(keyed, "__eui", first or "").drop("__eui"))


ViewFn = Callable[[Tables, RunContext], DataFrame]

VIEWS: dict[str, ViewFn] = {
    "stats": stats,
    "dashboard_kpis": dashboard_kpis,
    "device_status_breakdown": device_status_breakdown,
    "gateway_status_breakdown": gateway_status_breakdown,
    "devices_per_tenant": devices_per_tenant,
    "device_search": device_search,
    "devices_page": devices_page,
    "device_by_eui": device_by_eui,
    "page_walk": page_walk,
    "page_metadata": page_metadata,
    "online_gateways": online_gateways,
    "active_device_count": active_device_count,
    "device_quick_stats": device_quick_stats,
    "tenant_cards": tenant_cards,
    "application_cards": application_cards,
    "profile_cards": profile_cards,
    "low_battery_devices": low_battery_devices,
    "gateway_map": gateway_map_view,
    "permissions_matrix": permissions_matrix,
    "device_filters": device_filters,
    "active_servers": active_servers_view,
    "restricted_devices": restricted_devices,
    "orphan_devices": orphan_devices,
    "orphan_report": orphan_report,
    "preview_devices": preview_devices,
    "combined_servers": combined_servers,
    "by_server": rows_by_server,
    "age_labels": age_labels,
    "badges": badges,
    "numeric_parse": numeric_parse,
    "page_count": page_counts,
    "column_fallback": column_fallback,
}


def view_registry(ctx: RunContext) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from fleetlens.catalog import open_fleet

    def make(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(open_fleet(spark, sf_dir), ctx)
        run.__name__ = f"view_{fn.__name__}"
        return run

    from fleetlens.plans.lifecycle import LIFECYCLE
    return {name: make(fn) for name, fn in {**VIEWS, **LIFECYCLE}.items()}

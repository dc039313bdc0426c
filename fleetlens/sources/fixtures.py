"""Source-shaped fleet tables derived from the driver's parquet tables.

The network-server schema (tenant, application, device, ...) is mapped onto
the TPC-H-like driver tables as laid out in FIXTURES.md part B. Every table is
a lazy DataFrame expression over the driver tables, so its cost grows with
them; nothing is materialised here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.sources.tables import LazyTables

# Fixed values of the mapping (FIXTURES.md part B).
DAY_SHIFT = 8217                     # 2001-08-01 + 8217 days = 2024-01-30
ORPHAN_TENANT_NATION = 24            # customer of this nation -> no tenant
ORPHAN_DEVICE_MODULUS = 97           # orderkey % 97 = 0 -> application -1
CHILDLESS_CUSTKEY = (20, 7)          # custkey % 20 = 7 -> its devices have application -1
NO_SUCH_USER = (10, 3)               # suppkey % 10 = 3 -> bridge rows of a user that does not exist
KEYLESS_MODULUS = 3                  # orderkey % 3 = 0 -> keys of a device that does not exist
NO_SUCH_DEVICE = 1 << 40             # added to such a key
PROFILE_BLANK_MODULUS = 50           # partkey % 50 = 0 -> script of 3 spaces
RELAY_NEVER_MODULUS = 9              # suppkey % 9 = 0 -> relay never seen


def eui8(c: Column) -> Column:
    """Integer key as an 8-byte big-endian binary identifier."""
    return F.unhex(F.lpad(F.hex(c), 16, "0"))


def addr4(c: Column) -> Column:
    """Non-negative integer below 2^31 as a 4-byte binary address."""
    return F.unhex(F.lpad(F.hex(c), 8, "0"))


def ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def plus_days(t: Column, days) -> Column:
    n = days if isinstance(days, Column) else F.lit(days)
    return F.timestamp_add("DAY", n, t)


def _s(c: Column) -> Column:
    return c.cast("string")


def _tenant(t: dict) -> DataFrame:
    n = t["nation"]
    created = plus_days(ts("2020-01-01 00:00:00"), F.col("n_nationkey"))
    return n.select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("Tenant of region "), _s(F.col("n_regionkey"))).alias("description"),
        F.col("n_regionkey").alias("server_id"),
        (F.lit(1000) * (F.col("n_nationkey") + 1)).alias("max_device_count"),
        (F.lit(10) * (F.col("n_nationkey") % 5)).alias("max_gateway_count"),
        (F.col("n_nationkey") % 2 == 0).alias("can_have_gateways"),
        (F.col("n_nationkey") % 3 == 0).alias("private_gateways_up"),
        (F.col("n_nationkey") % 4 == 0).alias("private_gateways_down"),
        created.alias("created_at"),
        plus_days(created, 30).alias("updated_at"),
    )


def _tenant_of_customer() -> Column:
    return F.when(F.col("c_nationkey") != ORPHAN_TENANT_NATION, F.col("c_nationkey"))


def _application(t: dict) -> DataFrame:
    c = t["customer"]
    created = plus_days(ts("2021-01-01 00:00:00"), F.col("c_custkey") % 365)
    return c.select(
        F.col("c_custkey").alias("id"),
        _tenant_of_customer().alias("tenant_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("description"),
        created.alias("created_at"),
        plus_days(created, 7).alias("updated_at"),
    )


def _order_lines(t: dict) -> DataFrame:
    """Per order: first part (the device profile) and first/last ship date."""
    return t["lineitem"].groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("first_partkey"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )


def _device(t: dict) -> DataFrame:
    mod, rem = CHILDLESS_CUSTKEY
    o = t["orders"]
    lines = t["order_lines"].select("l_orderkey", "first_partkey")
    d = o.join(lines, o["o_orderkey"] == lines["l_orderkey"], "left")
    key = F.col("o_orderkey")
    low = F.col("o_orderpriority") == "5-LOW"
    return d.select(
        eui8(key).alias("dev_eui"),
        eui8(F.col("o_custkey")).alias("join_eui"),
        F.when((key % ORPHAN_DEVICE_MODULUS == 0) | (F.col("o_custkey") % mod == rem), F.lit(-1).cast("bigint"))
         .otherwise(F.col("o_custkey")).alias("application_id"),
        F.col("first_partkey").alias("device_profile_id"),
        F.concat(F.lit("dev-"), _s(key)).alias("name"),
        F.concat(F.lit("priority "), F.col("o_orderpriority")).alias("description"),
        F.when(F.col("o_orderstatus") == "F", "A")
         .when(F.col("o_orderstatus") == "O", "B")
         .when(F.col("o_orderstatus") == "P", "C").alias("enabled_class"),
        (key % 10 == 0).alias("is_disabled"),
        (key % 7 == 0).alias("skip_fcnt_check"),
        low.alias("external_power_source"),
        F.when(~low, (key % 101).cast("double")).alias("battery_level"),
        ((key % 31).cast("int") - 10).alias("margin"),
        (key % 6).cast("int").alias("dr"),
        (key * 7 % 65536).alias("f_cnt_up"),
        ((key % 180).cast("double") - 89.5).alias("latitude"),
        ((F.col("o_custkey") % 360).cast("double") - 179.75).alias("longitude"),
        (key % 500).cast("double").alias("altitude"),
        addr4(key % 2147483647).alias("dev_addr"),
        F.when(key % 5 == 0, addr4(key % 65536 + 1)).alias("secondary_dev_addr"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED",
               plus_days(F.col("o_orderdate"), DAY_SHIFT)).alias("last_seen_at"),
        plus_days(F.col("o_orderdate"), 8000).alias("created_at"),
        plus_days(F.col("o_orderdate"), 8100).alias("updated_at"),
    )


def _device_keys(t: dict) -> DataFrame:
    key = F.col("o_orderkey")
    k = _s(key)
    return t["orders"].select(
        eui8(F.when(key % KEYLESS_MODULUS == 0, key + NO_SUCH_DEVICE).otherwise(key)).alias("dev_eui"),
        F.unhex(F.md5(k)).alias("app_key"),
        F.unhex(F.md5(F.concat(k, F.lit("-nwk")))).alias("nwk_key"),
    )


def _last_event(t: dict) -> DataFrame:
    """Latest event per user: the 'last seen' of gateways and relays."""
    return t["events"].groupBy("user_id").agg(F.max("ts").alias("last_ts"))


def _gateway(t: dict) -> DataFrame:
    c = t["customer"]
    e = t["last_event"]
    g = c.join(e, c["c_custkey"] == e["user_id"], "left")
    key = F.col("c_custkey")
    created = plus_days(ts("2022-01-01 00:00:00"), key % 700)
    return g.select(
        eui8(key).alias("gateway_id"),
        _tenant_of_customer().alias("tenant_id"),
        F.concat(F.lit("gw-"), _s(key)).alias("name"),
        F.concat(F.lit("Gateway of "), F.col("c_name")).alias("description"),
        F.when(key % 4 != 3, (key % 170).cast("double") - 85.0).alias("latitude"),
        ((key % 360).cast("double") - 180.0).alias("longitude"),
        (key % 300).cast("double").alias("altitude"),
        F.lit(30).alias("stats_interval_secs"),
        F.col("last_ts").alias("last_seen_at"),
        created.alias("created_at"),
        plus_days(created, 1).alias("updated_at"),
    )


def _device_profile(t: dict) -> DataFrame:
    p = t["part"]
    d = t["documents"].select("doc_id", "text")
    j = p.join(d, p["p_partkey"] == d["doc_id"], "left")
    key = F.col("p_partkey")
    created = plus_days(ts("2021-06-01 00:00:00"), key % 500)
    return j.select(
        key.alias("id"),
        (F.col("p_size") % 25).alias("tenant_id"),
        F.concat(F.col("p_name"), F.lit("/"), F.col("p_brand")).alias("name"),
        F.col("p_type").alias("description"),
        F.when(F.col("p_size") % 2 == 0, "EU868").otherwise("US915").alias("region"),
        F.lit("LORAWAN_1_0_3").alias("mac_version"),
        F.lit("RP002_1_0_3").alias("reg_params_revision"),
        (key % 4 != 0).alias("supports_otaa"),
        (F.col("p_size") % 3 == 0).alias("supports_class_b"),
        (F.col("p_size") % 5 == 0).alias("supports_class_c"),
        F.when(key % 2 == 0, "JS").otherwise("NONE").alias("payload_codec_runtime"),
        F.when(F.col("text").isNotNull() & (key % PROFILE_BLANK_MODULUS == 0), F.lit("   "))
         .otherwise(F.col("text")).alias("payload_codec_script"),
        (F.col("p_size") * 60).alias("uplink_interval"),
        F.lit(1).alias("device_status_req_interval"),
        (F.col("p_size") % 3 + 1).alias("rx1_delay"),
        F.lit("default").alias("adr_algorithm_id"),
        F.lit(True).alias("flush_queue_on_activate"),
        (F.col("p_size") > 40).alias("allow_roaming"),
        (key % 3 == 0).alias("auto_detect_measurements"),
        created.alias("created_at"),
        plus_days(created, 10).alias("updated_at"),
    )


def _user(t: dict) -> DataFrame:
    s = t["supplier"]
    key = F.col("s_suppkey")
    created = plus_days(ts("2020-06-01 00:00:00"), key % 300)
    return s.select(
        key.alias("id"),
        F.concat(F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit("."))),
                 F.lit("@example.org")).alias("email"),
        (key % 5 == 0).alias("is_admin"),
        (key % 7 != 6).alias("is_active"),
        (key % 2 == 0).alias("email_verified"),
        F.when(key % 3 == 0, F.concat(F.lit("ext-"), _s(key))).alias("external_id"),
        F.col("s_name").alias("note"),
        created.alias("created_at"),
        plus_days(created, 2).alias("updated_at"),
    )


def _tenant_user(t: dict) -> DataFrame:
    mod, rem = NO_SUCH_USER
    supp = F.col("l_suppkey")
    li = t["lineitem"].select("l_orderkey", F.when(supp % mod == rem, -supp).otherwise(supp).alias("l_suppkey"))
    o = t["orders"].select("o_orderkey", "o_custkey")
    c = t["customer"].select("c_custkey", "c_nationkey")
    pairs = (li.join(o, li["l_orderkey"] == o["o_orderkey"])
               .join(c, F.col("o_custkey") == c["c_custkey"])
               .select(F.col("c_nationkey").alias("tenant_id"),
                       F.col("l_suppkey").alias("user_id"))
               .distinct())
    created = plus_days(ts("2023-01-01 00:00:00"), F.col("tenant_id"))
    return pairs.select(
        "tenant_id", "user_id",
        ((F.col("user_id") + F.col("tenant_id")) % 2 == 0).alias("is_admin"),
        (F.col("user_id") % 2 == 0).alias("is_device_admin"),
        (F.col("tenant_id") % 2 == 0).alias("is_gateway_admin"),
        created.alias("created_at"),
        plus_days(created, 3).alias("updated_at"),
    )


def _application_integration(t: dict) -> DataFrame:
    return t["events"].groupBy(
        F.col("user_id").alias("application_id"), F.col("event_type").alias("kind")
    ).agg(
        F.min("props").alias("configuration"),
        F.min("ts").alias("created_at"),
        F.max("ts").alias("updated_at"),
    )


def _multicast_parts(t: dict) -> DataFrame:
    return t["part"]


def _multicast_group(t: dict) -> DataFrame:
    p = t["multicast_parts"]
    key = F.col("p_partkey")
    return p.select(
        key.alias("id"),
        key.alias("application_id"),
        F.concat(F.lit("mcast-"), F.col("p_brand"), F.lit("-"), _s(key)).alias("name"),
        F.when(F.col("p_size") % 2 == 0, "EU868").otherwise("US915").alias("region"),
        addr4(key).alias("mc_addr"),
        F.unhex(F.md5(F.concat(F.lit("nwk-"), _s(key)))).alias("mc_nwk_s_key"),
        F.unhex(F.md5(F.concat(F.lit("app-"), _s(key)))).alias("mc_app_s_key"),
        (key * 3).alias("f_cnt"),
        F.when(F.col("p_size") % 2 == 0, "CLASS_B").otherwise("CLASS_C").alias("group_type"),
        F.col("p_size").alias("dr"),
        (F.lit(868100000) + F.col("p_size") * 200000).cast("bigint").alias("frequency"),
        (F.col("p_size") % 8).alias("class_b_ping_slot_periodicity"),
        F.when(key % 2 == 0, "DELAY").otherwise("GPS_TIME").alias("class_c_scheduling_type"),
    )


def _multicast_group_device(t: dict) -> DataFrame:
    g = t["lineitem"].groupBy("l_partkey", "l_orderkey").agg(F.min("l_shipdate").alias("created_at"))
    return g.select(
        F.col("l_partkey").alias("multicast_group_id"),
        eui8(F.col("l_orderkey")).alias("dev_eui"),
        "created_at",
    )


def _device_queue_item(t: dict) -> DataFrame:
    e = t["events"]
    key = F.col("event_id")
    return e.select(
        key.alias("id"),
        eui8(key).alias("dev_eui"),
        ((key % 223).cast("int") + 1).alias("f_port"),
        (key % 2 == 0).alias("confirmed"),
        F.when(F.col("event_type") != "error",
               F.col("event_type").isin("click", "view")).alias("is_pending"),
        (key % 5 == 0).alias("is_encrypted"),
        (key * 2).alias("f_cnt_down"),
        F.timestamp_add("MINUTE", F.lit(5), F.col("ts")).alias("timeout_after"),
        plus_days(F.col("ts"), 1).alias("expires_at"),
        F.col("ts").alias("created_at"),
    )


def _api_key(t: dict) -> DataFrame:
    s = t["supplier"]
    key = F.col("s_suppkey")
    return s.select(
        key.alias("id"),
        F.when(key % 4 != 0, F.col("s_nationkey")).alias("tenant_id"),
        F.concat(F.lit("key-"), _s(key)).alias("name"),
        (key % 4 == 0).alias("is_admin"),
        plus_days(ts("2023-03-01 00:00:00"), key % 90).alias("created_at"),
    )


def _relay_device(t: dict) -> DataFrame:
    g = (t["lineitem"].groupBy("l_suppkey", "l_orderkey")
         .agg(F.min("l_shipdate").alias("created_at")))
    return g.select(
        eui8(F.col("l_suppkey")).alias("relay_dev_eui"),
        eui8(F.col("l_orderkey")).alias("dev_eui"),
        "created_at",
    )


def _relay_gateway(t: dict) -> DataFrame:
    s = t["supplier"]
    e = t["last_event"]
    j = s.join(e, s["s_suppkey"] == e["user_id"], "left")
    key = F.col("s_suppkey")
    created = plus_days(ts("2022-06-01 00:00:00"), key % 200)
    return j.select(
        addr4(key).alias("relay_id"),
        F.col("s_nationkey").alias("tenant_id"),
        F.concat(F.lit("relay-"), _s(key)).alias("name"),
        F.col("s_name").alias("description"),
        F.when(F.col("s_nationkey") % 2 == 0, "eu868").otherwise("us915").alias("region_config_id"),
        F.lit(60).alias("stats_interval_secs"),
        F.when(key % RELAY_NEVER_MODULUS != 0, F.col("last_ts")).alias("last_seen_at"),
        created.alias("created_at"),
        plus_days(created, 1).alias("updated_at"),
    )


def _fuota_deployment(t: dict) -> DataFrame:
    o = t["orders"]
    lines = t["order_lines"]
    j = o.join(lines, o["o_orderkey"] == lines["l_orderkey"], "left")
    key = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    return j.select(
        key.alias("id"),
        F.col("o_custkey").alias("application_id"),
        F.col("first_partkey").alias("device_profile_id"),
        F.concat(F.lit("fuota-"), _s(key)).alias("name"),
        addr4(key % 2147483647).alias("multicast_addr"),
        F.lit("CLASS_C").alias("multicast_group_type"),
        F.lit("DELAY").alias("multicast_class_c_scheduling_type"),
        (key % 6).cast("int").alias("multicast_dr"),
        F.lit(868100000).cast("bigint").alias("multicast_frequency"),
        F.lit(60).alias("multicast_timeout"),
        F.lit(50).alias("fragmentation_fragment_size"),
        F.lit(10).alias("fragmentation_redundancy_percentage"),
        F.when(status == "F", "AFTER_FRAG_ENQ").otherwise("NO_REQUEST")
         .alias("request_fragmentation_session_status"),
        F.col("o_orderdate").alias("created_at"),
        plus_days(F.col("o_orderdate"), 1).alias("updated_at"),
        F.when(status != "P", F.col("first_ship")).alias("started_at"),
        F.when(status == "F", F.col("last_ship")).alias("completed_at"),
    )


def _server(t: dict) -> DataFrame:
    return t["region"].select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))


_BUILDERS = {
    "server": _server,
    "tenant": _tenant,
    "application": _application,
    "order_lines": _order_lines,
    "device": _device,
    "device_keys": _device_keys,
    "last_event": _last_event,
    "gateway": _gateway,
    "device_profile": _device_profile,
    "user": _user,
    "tenant_user": _tenant_user,
    "application_integration": _application_integration,
    "multicast_parts": _multicast_parts,
    "multicast_group": _multicast_group,
    "multicast_group_device": _multicast_group_device,
    "device_queue_item": _device_queue_item,
    "api_key": _api_key,
    "relay_device": _relay_device,
    "relay_gateway": _relay_gateway,
    "fuota_deployment": _fuota_deployment,
}

# Tables a caller sees; the rest are shared intermediate derivations.
SOURCE_TABLES = (
    "server", "tenant", "application", "device_profile", "device", "device_keys",
    "gateway", "user", "tenant_user", "application_integration", "multicast_group",
    "multicast_group_device", "device_queue_item", "api_key", "relay_device",
    "relay_gateway", "fuota_deployment",
)


def fleet_tables(raw) -> LazyTables:
    """Source-shaped tables over the driver tables ``raw`` (name -> DataFrame)."""
    holder: dict = {}

    class _View(dict):
        def __missing__(self, key):
            if key in raw:
                return raw[key]
            return holder["lazy"][key]

    view = _View()

    def bind(fn):
        return lambda: fn(view)

    lazy = LazyTables({k: bind(fn) for k, fn in _BUILDERS.items()})
    holder["lazy"] = lazy
    return lazy

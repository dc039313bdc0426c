"""The export compositions on hand-made source frames (FIXTURES.md §C)."""

from datetime import datetime, timedelta

from fleetlens.context import RunContext
from fleetlens.plans.exports import EXPORTS

AS_OF = datetime(2024, 1, 30, 23, 58, 0)
CTX = RunContext(as_of=AS_OF)


def _tables(spark):
    tenant = spark.createDataFrame(
        [(1, "alpha"), (2, "beta"), (3, "gamma"), (4, None)], "id int, name string")
    application = spark.createDataFrame(
        [(10, 1, "a10"), (11, 1, "a11-empty"), (20, 2, "a20"), (30, None, "orphan-app")],
        "id long, tenant_id int, name string")
    dev = "dev_eui binary, application_id long, is_disabled boolean, battery_level double, " \
          "enabled_class string, last_seen_at timestamp_ntz"
    device = spark.createDataFrame([
        (b"\x01", 10, False, 20.0, "A", AS_OF - timedelta(hours=1)),      # 20 is not low
        (b"\x02", 10, True, 19.99, "B", AS_OF - timedelta(days=2)),       # 19.99 is low
        (b"\x03", 10, None, None, "C", None),                             # unknown flags
        (b"\x04", 20, False, None, "A", AS_OF - timedelta(days=8)),       # all batteries NULL
        (b"\x05", 30, False, 50.0, "A", AS_OF),                           # app without tenant
        (b"\x06", 99, False, 60.0, "A", AS_OF),                           # orphan application
    ], dev)
    gw = "gateway_id binary, tenant_id int, last_seen_at timestamp_ntz"
    gateway = spark.createDataFrame([
        (b"\x0a", 1, AS_OF - timedelta(minutes=1)),
        (b"\x0b", 1, AS_OF - timedelta(hours=1)),                         # recent and offline
        (b"\x0c", 2, None),                                               # never seen: offline
    ], gw)
    user = spark.createDataFrame([(100, "u@x"), (101, "v@x"), (102, "w@x")], "id long, email string")
    tenant_user = spark.createDataFrame([(1, 100), (2, 100), (4, 100), (3, 101), (9, 101)],
                                        "tenant_id int, user_id long")
    return {"tenant": tenant, "application": application, "device": device, "gateway": gateway,
            "user": user, "tenant_user": tenant_user}


def test_device_summary_edges(spark):
    t = _tables(spark)
    rows = {r.tenant_id: r for r in EXPORTS["device_summary"].build(t, CTX).collect()}
    a = rows["1"]
    assert (a.total_devices, a.active_devices, a.disabled_devices) == (3, 1, 1)
    assert (a.devices_seen_24h, a.devices_seen_7d) == (1, 2)
    assert (a.battery_powered_devices, a.low_battery_devices, a.avg_battery_level) == (2, 1, 20.0)
    assert (a.class_a_devices, a.class_b_devices, a.class_c_devices) == (1, 1, 1)
    b = rows["2"]
    assert (b.total_devices, b.battery_powered_devices, b.avg_battery_level) == (1, 0, None)
    c = rows["3"]                                   # tenant without applications
    assert (c.total_devices, c.active_devices, c.avg_battery_level) == (0, 0, None)
    assert len(rows) == 4                           # every tenant, the nameless one too
    assert sum(r.total_devices for r in rows.values()) == 4   # orphans and tenant-less apps drop out


def test_gateway_summary_edges(spark):
    t = _tables(spark)
    rows = {r.tenant_id: r for r in EXPORTS["gateway_summary"].build(t, CTX).collect()}
    a = rows["1"]
    assert (a.total_gateways, a.online_gateways, a.recent_gateways, a.offline_gateways) == (2, 1, 1, 1)
    b = rows["2"]
    assert (b.total_gateways, b.online_gateways, b.offline_gateways) == (1, 0, 1)
    c = rows["3"]                                   # no gateways: the LEFT JOIN row counts as offline
    assert (c.total_gateways, c.offline_gateways, c.last_gateway_activity) == (0, 1, None)


def test_tenants_with_counts_edges(spark):
    t = _tables(spark)
    rows = {r.tenant_id: r for r in EXPORTS["tenants_with_counts"].build(
        {**t, "tenant": t["tenant"].selectExpr(
            "id", "name", "CAST(NULL AS STRING) AS description", "0 AS max_device_count",
            "0 AS max_gateway_count", "true AS can_have_gateways", "false AS private_gateways_up",
            "false AS private_gateways_down", "CAST(NULL AS TIMESTAMP_NTZ) AS created_at",
            "CAST(NULL AS TIMESTAMP_NTZ) AS updated_at")}, CTX).collect()}
    assert (rows["1"].total_devices, rows["1"].active_devices, rows["1"].total_gateways,
            rows["1"].online_gateways) == (3, 1, 2, 1)
    assert (rows["3"].total_devices, rows["3"].total_gateways) == (0, 0)   # no fan-out, no NULLs


def test_users_string_aggregate_edges(spark):
    t = _tables(spark)
    t["user"] = t["user"].selectExpr("id", "email", "false AS is_admin", "true AS is_active",
                                     "true AS email_verified", "CAST(NULL AS STRING) AS external_id",
                                     "CAST(NULL AS STRING) AS note", "CAST(NULL AS TIMESTAMP_NTZ) AS created_at",
                                     "CAST(NULL AS TIMESTAMP_NTZ) AS updated_at")
    rows = {r.user_id: r for r in EXPORTS["users"].build(t, CTX).collect()}
    # three tenants, one of them without a name: listed names skip it, the count does not
    assert (rows["100"].tenant_access, rows["100"].tenant_count) == ("alpha, beta", 3)
    # one known tenant and one missing tenant id
    assert (rows["101"].tenant_access, rows["101"].tenant_count) == ("gamma", 1)
    # no tenants at all
    assert (rows["102"].tenant_access, rows["102"].tenant_count) == (None, 0)

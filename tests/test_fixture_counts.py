"""The fixture mapping reproduces the counts documented in FIXTURES.md.

sf0.001 and sf0.01 run by default; sf0.1 with FLEETLENS_BIG=1.
"""

import os

import pytest
from pyspark.sql import functions as F

from fleetlens.catalog import open_fleet
from fleetlens.context import DEFAULT_CONTEXT as CTX
from fleetlens.functions.exprs import device_activity, gateway_connection, non_blank

# The counts table of FIXTURES.md, per scale factor.
EXPECTED = {
    "sf0.001": dict(sizes=(1500, 150, 150), device=(1, 8, 1194, 297), gateway=(0, 1, 14, 135),
                    relay=(0, 0, 8, 2), childless_orphans=(8, 105), profiles=(200, 0, 4, 168),
                    no_profile=27, users_without_tenant=1, queue=(398, 401, 201), fuota=(484, 507, 509)),
    "sf0.01": dict(sizes=(15000, 1500, 1500), device=(1, 42, 11937, 3020), gateway=(1, 12, 137, 1350),
                   relay=(1, 10, 77, 12), childless_orphans=(75, 920), profiles=(2000, 1000, 20, 977),
                   no_profile=257, users_without_tenant=10, queue=(3988, 3998, 2014), fuota=(4859, 4884, 5257)),
    "sf0.1": dict(sizes=(150000, 15000, 15000), device=(56, 306, 119718, 29920),
                  gateway=(12, 108, 1380, 13500), relay=(7, 55, 826, 112), childless_orphans=(751, 8969),
                  profiles=(20000, 10000, 200, 9780), no_profile=2764, users_without_tenant=100,
                  queue=(39804, 40386, 19810), fuota=(48735, 49198, 52067)),
}
SCALES = ["sf0.001", "sf0.01"] + (["sf0.1"] if os.environ.get("FLEETLENS_BIG") else [])


def _dist(df, col):
    return {r[0]: r[1] for r in df.groupBy(col).count().collect()}


def _four(dist, labels):
    return tuple(dist.get(label, 0) for label in labels)


@pytest.mark.parametrize("sf", SCALES)
def test_fixture_counts(spark, sf):
    exp = EXPECTED[sf]
    t = open_fleet(spark, f"/root/testdata/{sf}")
    apps, dev, tenants = t["application"], t["device"], t["tenant"]
    assert (dev.count(), apps.count(), t["gateway"].count()) == exp["sizes"]

    d = dev.select(device_activity(F.col("last_seen_at"), CTX).alias("s"))
    assert _four(_dist(d, "s"), ("Active", "Recent", "Inactive", "Never")) == exp["device"]
    g = t["gateway"].select(gateway_connection(F.col("last_seen_at"), CTX).alias("s"))
    assert _four(_dist(g, "s"), ("Online", "Recent", "Offline", "Never Seen")) == exp["gateway"]
    r = t["relay_gateway"].select(gateway_connection(F.col("last_seen_at"), CTX).alias("s"))
    assert _four(_dist(r, "s"), ("Online", "Recent", "Offline", "Never Seen")) == exp["relay"]

    childless = apps.join(dev, apps["id"] == dev["application_id"], "left_anti").count()
    orphan = dev.join(apps, dev["application_id"] == apps["id"], "left_anti").count()
    assert (childless, orphan) == exp["childless_orphans"]
    no_app = tenants.join(apps, tenants["id"] == apps["tenant_id"], "left_anti").count()
    no_gw = tenants.join(t["gateway"], tenants["id"] == t["gateway"]["tenant_id"], "left_anti").count()
    assert (no_app, no_gw) == (1, 1)

    p = t["device_profile"]
    script = F.col("payload_codec_script")
    used = dev.select(F.col("device_profile_id").alias("pid")).distinct()
    q8 = p.filter(non_blank(script)).join(used, p["id"] == used["pid"], "left_semi").count()
    assert (p.count(), p.filter(script.isNull()).count(),
            p.filter(script.isNotNull() & (F.trim(script) == "")).count(), q8) == exp["profiles"]
    assert dev.filter(F.col("device_profile_id").isNull()).count() == exp["no_profile"]

    users, tu = t["user"], t["tenant_user"]
    assert users.join(tu, users["id"] == tu["user_id"], "left_anti").count() == exp["users_without_tenant"]
    q = _dist(t["device_queue_item"], "is_pending")
    assert (q.get(True, 0), q.get(False, 0), q.get(None, 0)) == exp["queue"]
    status = (F.when(F.col("completed_at").isNotNull(), "Completed")
               .when(F.col("started_at").isNotNull(), "In Progress").otherwise("Pending"))
    f = _dist(t["fuota_deployment"].select(status.alias("s")), "s")
    assert _four(f, ("Completed", "In Progress", "Pending")) == exp["fuota"]

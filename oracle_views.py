"""DuckDB oracle SQL of the read-side queries (views and §7.6 extras)."""

from __future__ import annotations

from oracle_sql import (
    AS_OF, DEVICE_ACTIVITY, DEVICE_SUMMARY_CTES, DEVICE_SUMMARY_SELECT, DEVICES_CTES, DEVICES_SELECT,
    EXPORT_DATE, GATEWAY_SUMMARY_CTES, GATEWAY_SUMMARY_SELECT, GATEWAYS_SELECT, RUN_ID, SERVER,
    CODEC_PREDICATE, _ago, _connection, _hex, export_queries, with_ctes,
)

N_RUN_EXPORTS = 20


def _age_label(ts: str) -> str:
    secs = f"CAST(floor(epoch({AS_OF}) - epoch({ts})) AS BIGINT)"
    return f"""CASE WHEN {ts} IS NULL THEN 'Never'
        WHEN {secs} < 60 THEN 'just now'
        WHEN {secs} < 3600 THEN CAST(CAST(floor({secs} / 60) AS BIGINT) AS VARCHAR) || ' min ago'
        WHEN {secs} < 86400 THEN CAST(CAST(floor({secs} / 3600) AS BIGINT) AS VARCHAR) || 'h ago'
        ELSE CAST(CAST(floor({secs} / 86400) AS BIGINT) AS VARCHAR) || 'd ago' END"""


def _parse_int(x: str) -> str:
    """Strict integer parse: digits with an optional sign, else NULL."""
    v = f"trim(COALESCE({x}, ''))"
    return f"CASE WHEN regexp_full_match({v}, '[+-]?[0-9]+') THEN TRY_CAST({v} AS BIGINT) END"


def _badge(s: str) -> str:
    return f"""CASE WHEN {s} IN ('Online', 'Active') THEN 'green' WHEN {s} = 'Recent' THEN 'amber'
        WHEN {s} IN ('Offline', 'Inactive') THEN 'red' ELSE 'gray' END"""


KPI_CTES = DEVICE_SUMMARY_CTES + GATEWAY_SUMMARY_CTES + ("f_device_profile", "f_server")
KPI_BASE = f"""
ds AS ({DEVICE_SUMMARY_SELECT}),
gs AS ({GATEWAY_SUMMARY_SELECT}),
codecs AS (SELECT COUNT(*) AS n FROM f_device_profile dp WHERE {CODEC_PREDICATE})
"""


def _kpi(body: str) -> str:
    return with_ctes(KPI_CTES, "").rstrip() + ",\n" + KPI_BASE + body


def view_queries() -> dict[str, str]:
    ex = export_queries()
    q: dict[str, str] = {}
    q["stats"] = _kpi(f"""
SELECT '{SERVER}' AS server_name, '{EXPORT_DATE}' AS last_export,
       CAST({N_RUN_EXPORTS} AS BIGINT) AS exports_available,
       (SELECT n FROM codecs) AS codecs_available,
       (SELECT COUNT(*) FROM ds) AS tenants,
       (SELECT CAST(SUM(total_devices) AS BIGINT) FROM ds) AS total_devices,
       (SELECT CAST(SUM(active_devices) AS BIGINT) FROM ds) AS active_devices,
       (SELECT CAST(SUM(total_gateways) AS BIGINT) FROM gs) AS total_gateways,
       (SELECT CAST(SUM(online_gateways) AS BIGINT) FROM gs) AS online_gateways""")
    q["dashboard_kpis"] = _kpi(f"""
SELECT (SELECT COUNT(*) FROM ds) AS tenants,
       (SELECT CAST(SUM(total_devices) AS BIGINT) FROM ds) AS total_devices,
       (SELECT CAST(SUM(online_gateways) AS BIGINT) FROM gs) AS online_gateways,
       (SELECT CAST(SUM(devices_seen_24h) AS BIGINT) FROM ds) AS active_devices_24h,
       (SELECT n FROM codecs) AS codecs_available, '{EXPORT_DATE}' AS last_export,
       (SELECT COUNT(*) FROM f_server) AS servers""")
    q["device_status_breakdown"] = with_ctes(("f_device",), f"""
SELECT {DEVICE_ACTIVITY} AS status, COUNT(*) AS count FROM f_device d GROUP BY 1
UNION ALL
SELECT 'Disabled', COUNT(*) FROM f_device WHERE is_disabled HAVING COUNT(*) > 0""")
    q["gateway_status_breakdown"] = with_ctes(("f_gateway",), f"""
SELECT COALESCE({_connection("g")}, 'Unknown') AS status, COUNT(*) AS count FROM f_gateway g GROUP BY 1""")
    q["devices_per_tenant"] = with_ctes(DEVICE_SUMMARY_CTES, f"""
SELECT tenant_name, tenant_id, total_devices FROM ({DEVICE_SUMMARY_SELECT})""")
    search_base = with_ctes(("f_device", "f_application"), f"""
, m AS (
  SELECT {_hex("d.dev_eui")} AS device_eui, d.name AS device_name, a.name AS application_name,
         CAST(d.application_id AS VARCHAR) AS application_id, d.battery_level, d.is_disabled,
         {DEVICE_ACTIVITY} AS activity_status
  FROM f_device d LEFT JOIN f_application a ON d.application_id = a.id)
, hits AS (SELECT * FROM m WHERE contains(lower(device_name), '42') OR contains(lower(device_eui), '42')
                             OR contains(lower(application_name), '42'))
SELECT h.*, '42' AS query, (SELECT COUNT(*) FROM hits) AS match_count
FROM (SELECT * FROM hits ORDER BY device_name, device_eui LIMIT 100) h""")
    # with_ctes puts a newline between the WITH list and the body; the body
    # here continues the list, so join them.
    q["device_search"] = search_base.replace("\n, m AS", ", m AS", 1)
    q["devices_page"] = with_ctes(DEVICES_CTES, f"""
SELECT * FROM ({DEVICES_SELECT}) ORDER BY device_name, device_eui LIMIT 100 OFFSET 200""")
    q["device_by_eui"] = _wrap(ex["devices"], "SELECT * FROM __q ORDER BY device_eui LIMIT 1")
    q["page_walk"] = with_ctes(("f_device",), f"""
SELECT device_eui, device_name, CAST(1 + (row_number() OVER (ORDER BY device_name NULLS LAST, device_eui) - 1) // 500 AS INTEGER) AS page
FROM (SELECT {_hex("dev_eui")} AS device_eui, name AS device_name FROM f_device)""")
    from oracle_lifecycle import RUN_EXPORTS
    q["page_metadata"] = "\nUNION ALL\n".join(f"""
SELECT '{n}' AS export_name, total, 3 AS page, 100 AS page_limit, CAST((total + 99) // 100 AS BIGINT) AS total_pages,
       CASE WHEN total > 300 THEN 4 END AS next_page, 2 AS previous_page
FROM (SELECT COUNT(*) AS total FROM ({ex[n]}))""" for n in RUN_EXPORTS)
    q["online_gateways"] = with_ctes(("f_gateway", "f_tenant"), f"""
SELECT * FROM ({GATEWAYS_SELECT}) WHERE connection_status = 'Online'""")
    q["active_device_count"] = with_ctes(("f_device",), f"""
SELECT COUNT(CASE WHEN ({DEVICE_ACTIVITY}) = 'Active' THEN 1 END) AS active_device_count FROM f_device d""")
    q["device_quick_stats"] = with_ctes(("f_device",), f"""
SELECT COUNT(*) AS total,
       COUNT(CASE WHEN last_seen_at > {_ago("24 HOUR")} THEN 1 END) AS active_24h,
       COUNT(CASE WHEN last_seen_at > {_ago("7 DAY")} THEN 1 END) AS recent_7d,
       COUNT(CASE WHEN enabled_class = 'A' THEN 1 END) AS class_a,
       COUNT(CASE WHEN battery_level < 20 THEN 1 END) AS low_battery,
       COUNT(CASE WHEN is_disabled THEN 1 END) AS disabled
FROM f_device""")
    twc = ex["tenants_with_counts"]
    q["tenant_cards"] = _wrap(twc, "SELECT tenant_id, tenant_name, source_server, total_devices AS device_count, "
                                   "total_gateways AS gateway_count FROM __q")
    q["application_cards"] = with_ctes(("f_application", "f_tenant", "f_device"), """
SELECT CAST(a.id AS VARCHAR) AS application_id, a.name AS application_name, t.name AS tenant_name,
       (SELECT COUNT(*) FROM f_device d WHERE d.application_id = a.id) AS device_count
FROM f_application a LEFT JOIN f_tenant t ON a.tenant_id = t.id""")
    q["profile_cards"] = with_ctes(("f_device_profile", "f_device"), """
SELECT CAST(dp.id AS VARCHAR) AS profile_id, dp.name AS profile_name,
       (SELECT COUNT(*) FROM f_device d WHERE d.device_profile_id = dp.id) AS device_count
FROM f_device_profile dp""")
    q["low_battery_devices"] = with_ctes(("f_device", "f_application", "f_tenant"), f"""
SELECT {_hex("d.dev_eui")} AS device_eui, d.name AS device_name, d.battery_level,
       a.name AS application_name, t.name AS tenant_name, {DEVICE_ACTIVITY} AS activity_status
FROM f_device d LEFT JOIN f_application a ON d.application_id = a.id
LEFT JOIN f_tenant t ON a.tenant_id = t.id
WHERE d.battery_level < 20""")
    q["gateway_map"] = with_ctes(("f_gateway", "f_tenant"), f"""
SELECT gateway_eui, gateway_name, latitude, longitude, connection_status,
       {_age_label("last_seen_at")} AS last_seen_label, {_badge("connection_status")} AS badge
FROM ({GATEWAYS_SELECT}) WHERE latitude IS NOT NULL AND longitude IS NOT NULL""")
    q["permissions_matrix"] = _wrap(ex["tenant_user_roles"],
                                    "SELECT user_email, user_id, tenant_name, tenant_id, is_tenant_admin, "
                                    "is_device_admin, is_gateway_admin FROM __q")
    q["device_filters"] = with_ctes(("f_device", "f_application", "f_tenant"), f"""
SELECT {_hex("d.dev_eui")} AS device_eui, d.name AS device_name, a.name AS application_name,
       t.name AS tenant_name
FROM f_device d LEFT JOIN f_application a ON d.application_id = a.id
LEFT JOIN f_tenant t ON a.tenant_id = t.id
WHERE d.is_disabled = false AND t.name = 'NATION_1'""")
    q["active_servers"] = _wrap(ex["servers"], "SELECT * FROM __q WHERE status = 'Active'")
    q["restricted_devices"] = _wrap(ex["devices"], """
SELECT * REPLACE (CASE WHEN app_key IS NOT NULL THEN '***' END AS app_key,
                  CASE WHEN network_key IS NOT NULL THEN '***' END AS network_key) FROM __q""")
    q["orphan_devices"] = with_ctes(("f_device", "f_application"), f"""
SELECT {_hex("d.dev_eui")} AS device_eui, d.name AS device_name, CAST(d.application_id AS VARCHAR) AS application_id
FROM f_device d
WHERE d.application_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM f_application a WHERE a.id = d.application_id)""")
    from fleetlens.plans.views import FOREIGN_KEYS
    tables = sorted({f"f_{c}" for c, _, p, _ in FOREIGN_KEYS} | {f"f_{p}" for c, _, p, _ in FOREIGN_KEYS})
    parts = [f"""SELECT '{c}' AS child_table, '{fk}' AS foreign_key, '{p}' AS parent_table,
       (SELECT COUNT(*) FROM f_{c} x WHERE x.{fk} IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM f_{p} y WHERE y.{pk} = x.{fk})) AS orphan_rows"""
             for c, fk, p, pk in FOREIGN_KEYS]
    q["orphan_report"] = with_ctes(tables, "\nUNION ALL\n".join(parts))
    q["preview_devices"] = _wrap(ex["devices"], "SELECT * FROM __q ORDER BY device_eui LIMIT 10")
    q["combined_servers"] = with_ctes(("f_application", "f_tenant", "f_server"), f"""
SELECT CAST(a.id AS VARCHAR) AS application_id, a.name AS application_name, a.description,
       t.name AS tenant_name, CAST(a.tenant_id AS VARCHAR) AS tenant_id, a.created_at, a.updated_at,
       COALESCE(s.name, 'unassigned') AS source_server, '{RUN_ID}' AS export_timestamp
FROM f_application a LEFT JOIN f_tenant t ON a.tenant_id = t.id LEFT JOIN f_server s ON t.server_id = s.id""")
    q["by_server"] = with_ctes(("f_application", "f_tenant", "f_server"), """
SELECT COALESCE(s.name, 'unassigned') AS source_server, COUNT(*) AS row_count
FROM f_application a LEFT JOIN f_tenant t ON a.tenant_id = t.id LEFT JOIN f_server s ON t.server_id = s.id
GROUP BY 1""")
    q["age_labels"] = with_ctes(("f_gateway",), f"""
SELECT {_hex("gateway_id")} AS gateway_eui, last_seen_at, {_age_label("last_seen_at")} AS age_label
FROM f_gateway""")
    q["badges"] = with_ctes(("f_device",), f"""
SELECT activity_status, COUNT(*) AS devices, {_badge("activity_status")} AS badge
FROM (SELECT {DEVICE_ACTIVITY} AS activity_status FROM f_device d) GROUP BY activity_status""")
    q["numeric_parse"] = with_ctes(DEVICE_SUMMARY_CTES, f"""
SELECT tenant_id, {_parse_int("CAST(total_devices AS VARCHAR)")} AS total_devices,
       {_parse_int("CAST(avg_battery_level AS VARCHAR)")} AS avg_battery_whole
FROM ({DEVICE_SUMMARY_SELECT})""")
    q["page_count"] = with_ctes(("f_device",), """
SELECT page_limit, total, CAST(ceil(total / page_limit) AS BIGINT) AS total_pages
FROM (SELECT COUNT(*) AS total FROM f_device) c,
     (VALUES (1), (7), (100), (1000)) v(page_limit)""")
    q["column_fallback"] = with_ctes(("f_device",), f"""
SELECT {_hex("dev_eui")} AS device_eui, f_cnt_up AS frame_counter_up,
       COALESCE(f_cnt_up, 0) AS frame_counter_up_old_schema FROM f_device""")
    return q


def _wrap(sql: str, outer: str) -> str:
    """Use a complete query (possibly with its own WITH) as ``__q``."""
    return f"WITH __q AS ({sql})\n{outer}"

"""DuckDB oracle SQL of the lifecycle queries (files, snapshots, sync)."""

from __future__ import annotations

from oracle_sql import (
    AS_OF, CODEC_PREDICATE, DEVICE_SUMMARY_CTES, DEVICE_SUMMARY_SELECT, DEVICES_CTES, DEVICES_SELECT,
    EXPORT_DATE, GATEWAYS_SELECT, RUN_ID, SAFE_FILENAME, SERVER,
    export_queries, with_ctes,
)

PREV_AS_OF = "TIMESTAMP '2024-01-29 23:58:00'"
PREV_RUN_ID = "20240129_235800"

RUN_EXPORTS = ("servers", "tenants", "applications", "device_profiles", "devices", "gateways",
               "device_classes", "payload_codecs_metadata", "device_summary", "gateway_summary",
               "users", "tenant_user_roles", "integrations", "multicast_groups",
               "multicast_group_devices", "device_queue", "api_keys", "relay_devices",
               "relay_gateways", "fuota_deployments")

DEVICE_COLUMNS = ("device_eui", "join_eui", "app_key", "network_key", "device_name", "description",
                  "application_name", "application_id", "device_profile_name", "device_profile_id",
                  "tenant_name", "tenant_id", "enabled_class", "is_disabled", "skip_fcnt_check",
                  "external_power_source", "battery_level", "margin", "data_rate", "frame_counter_up",
                  "latitude", "longitude", "altitude", "device_address", "secondary_device_address",
                  "last_seen_at", "created_at", "updated_at", "source_server", "export_timestamp",
                  "activity_status")


PROFILE_BOOLEANS = ("supports_otaa", "supports_class_b", "supports_class_c", "flush_queue_on_activate",
                    "allow_roaming", "auto_detect_measurements")
PROFILE_EXPORT_COLUMNS = ("profile_id", "profile_name", "description", "tenant_name", "tenant_id", "region",
                          "mac_version", "reg_params_revision", "supports_otaa", "supports_class_b",
                          "supports_class_c", "payload_codec_runtime", "uplink_interval",
                          "device_status_req_interval", "rx1_delay", "adr_algorithm_id",
                          "flush_queue_on_activate", "allow_roaming", "auto_detect_measurements",
                          "created_at", "updated_at", "source_server", "export_timestamp")


def _profiles_stringly(profiles_sql: str) -> str:
    """The device-profile export with every value as text, NULL as '' and
    booleans as t/f."""
    cols = []
    for c in PROFILE_EXPORT_COLUMNS:
        if c in PROFILE_BOOLEANS:
            cols.append(f"COALESCE(CASE WHEN {c} THEN 't' WHEN NOT {c} THEN 'f' END, '') AS {c}")
        else:
            cols.append(f"COALESCE(CAST({c} AS VARCHAR), '') AS {c}")
    return f"WITH __p AS ({profiles_sql})\nSELECT {', '.join(cols)} FROM __p"


def _devices_at(as_of: str, run_id: str) -> str:
    return DEVICES_SELECT.replace(AS_OF, as_of).replace(f"'{RUN_ID}'", f"'{run_id}'")


def _device_snapshots() -> str:
    """CTEs old (yesterday, all devices) and new (today, seen devices)."""
    return with_ctes(DEVICES_CTES, "").rstrip() + f""",
old AS ({_devices_at(PREV_AS_OF, PREV_RUN_ID)}),
new AS (SELECT * FROM ({DEVICES_SELECT}) WHERE activity_status <> 'Never')
"""


#: File order of every sorted export: ORDER BY, and the columns that identify a row.
EXPORT_ORDER = {
    "servers": ("server_name", ("server_id",)), "tenants": ("tenant_name", ("tenant_id",)),
    "applications": ("application_name", ("application_id",)), "device_profiles": ("profile_name", ("profile_id",)),
    "devices": ("device_name", ("device_eui",)), "gateways": ("gateway_name", ("gateway_eui",)),
    "payload_codecs_metadata": ("tenant_name, profile_name", ("profile_id",)),
    "device_summary": ("tenant_name", ("tenant_id",)), "gateway_summary": ("tenant_name", ("tenant_id",)),
    "users": ("email", ("user_id",)), "tenant_user_roles": ("tenant_name, user_email", ("tenant_id", "user_id")),
    "integrations": ("application_name, integration_type",
                     ("application_id", "created_at", "updated_at", "configuration_json")),
    "multicast_groups": ("group_name", ("multicast_group_id",)),
    "multicast_group_devices": ("multicast_group_name, device_name", ("multicast_group_id", "device_eui")),
    "device_queue": ("created_at DESC", ("queue_item_id",)), "api_keys": ("api_key_name", ("api_key_id",)),
    "relay_devices": ("relay_device_name, device_name", ("relay_device_eui", "device_eui")),
    "relay_gateways": ("relay_gateway_name", ("relay_gateway_id",)),
    "fuota_deployments": ("created_at DESC", ("deployment_id",)),
}


def _nulls(col: str) -> str:
    return f"{col} NULLS FIRST" if col.endswith("DESC") else f"{col} ASC NULLS LAST"


def _order_by(name: str) -> str:
    order, unique = EXPORT_ORDER[name]
    return ", ".join(_nulls(c.strip()) for c in [*order.split(","), *unique])


def _search_case(needle: str, devices: str) -> str:
    return f"""
SELECT '{needle}' AS query, n AS match_count, h.device_eui
FROM (SELECT COUNT(*) AS n FROM {devices} WHERE {_holds(needle)}) c
LEFT JOIN (SELECT device_eui FROM {devices} WHERE {_holds(needle)} ORDER BY device_name, device_eui LIMIT 100) h ON true"""


def _holds(needle: str) -> str:
    return " OR ".join(f"contains(lower({c}), '{needle.lower()}')" for c in ("device_name", "device_eui", "application_name"))


SEARCH_CASES = ("7", "V-", "dev", "#00000012", "0000000000000001", "r#000000077", "no such device at all")


def lifecycle_queries() -> dict[str, str]:
    from oracle_views import view_queries
    ex = export_queries()
    q: dict[str, str] = {}
    q["csv_roundtrip"] = with_ctes(("f_gateway", "f_tenant"), f"""
SELECT *, CASE right(gateway_eui, 1) WHEN '0' THEN '  ' || gateway_name || ' ' WHEN '1' THEN chr(9)
            WHEN '2' THEN gateway_name || chr(13) || chr(10) || 'next' WHEN '3' THEN '' WHEN '4' THEN NULL
            WHEN '5' THEN '"q", ' || gateway_name ELSE gateway_name END AS note
FROM ({GATEWAYS_SELECT})""")
    q["json_roundtrip"] = _profiles_stringly(ex["device_profiles"])
    codec_base = with_ctes(("f_device_profile", "f_device"), "")
    q["codec_listing"] = codec_base + f"""
SELECT regexp_replace({SAFE_FILENAME}, '\\.js$', '') AS name, {SAFE_FILENAME} AS codec_file,
       CAST(strlen(dp.payload_codec_script) + 1 AS INTEGER) AS size_bytes
FROM f_device_profile dp WHERE {CODEC_PREDICATE}"""
    q["codec_by_name"] = codec_base + f"""
SELECT {SAFE_FILENAME} AS codec_file, s.with_suffix,
       CAST(strlen(dp.payload_codec_script) + 1 AS INTEGER) AS size_bytes,
       CAST(length(dp.payload_codec_script) AS INTEGER) AS script_chars
FROM f_device_profile dp, (VALUES (false), (true)) s(with_suffix) WHERE {CODEC_PREDICATE}"""
    q["codec_completeness"] = codec_base + f"""
SELECT COUNT(*) AS expected_codecs, COUNT(*) AS written_codecs, CAST(0 AS BIGINT) AS missing_codecs
FROM f_device_profile dp WHERE {CODEC_PREDICATE}"""
    q["archive_current"] = with_ctes(DEVICE_SUMMARY_CTES, DEVICE_SUMMARY_SELECT)
    q["current_device_search"] = with_ctes(DEVICES_CTES, "").rstrip() + f""",
cur AS ({DEVICES_SELECT}),
hits AS (SELECT * FROM cur WHERE contains(lower(device_name), '42') OR contains(lower(device_eui), '42')
                            OR contains(lower(application_name), '42'))
SELECT h.*, '42' AS query, (SELECT COUNT(*) FROM hits) AS match_count
FROM (SELECT * FROM hits ORDER BY device_name, device_eui LIMIT 100) h"""
    q["current_devices_page"] = with_ctes(DEVICES_CTES, f"SELECT * FROM ({DEVICES_SELECT}) ORDER BY {_order_by('devices')} LIMIT 100 OFFSET 200")
    q["current_device_by_eui"] = with_ctes(DEVICES_CTES, f"SELECT * FROM ({DEVICES_SELECT}) ORDER BY device_eui LIMIT 1")
    q["current_search_cases"] = (with_ctes(DEVICES_CTES, "").rstrip() + f",\ncur AS ({DEVICES_SELECT})\n"
                                 + "\nUNION ALL\n".join(_search_case(n, "cur") for n in SEARCH_CASES))
    q["gathered_counts"] = "\nUNION ALL\n".join(
        f"""SELECT '{n}' AS export_name, (SELECT COUNT(*) FROM ({ex[n]})) AS records,
       {f"(SELECT MIN(CAST({key} AS VARCHAR)) FROM ({ex[n]}))" if key else "CAST(NULL AS VARCHAR)"} AS first_key,
       {f"(SELECT MAX(CAST({key} AS VARCHAR)) FROM ({ex[n]}))" if key else "CAST(NULL AS VARCHAR)"} AS last_key,
       (SELECT COUNT(*) FILTER (v IS NULL) FROM (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM ({ex[n]}))
        UNPIVOT INCLUDE NULLS (v FOR c IN (COLUMNS(*)))) AS null_values"""
        for n in RUN_EXPORTS for key in [EXPORT_ORDER[n][1][0] if n in EXPORT_ORDER else None])
    q["export_order"] = "\nUNION ALL\n".join(
        f"""SELECT '{n}' AS export_name, row_number() OVER (ORDER BY {_order_by(n)}) - 1 AS place,
       concat_ws('|', {", ".join(f"COALESCE(CAST({c} AS VARCHAR), '-')" for c in unique)}) AS row_key FROM ({ex[n]})"""
        for n, (_, unique) in EXPORT_ORDER.items())
    q["health"] = with_ctes(("f_device",), f"""
SELECT 'ok' AS status, '{EXPORT_DATE}' AS last_export, '{SERVER}' AS server,
       COUNT(*) AS device_records, MAX(last_seen_at) AS last_contact FROM f_device""")
    q["sync_freshness"] = with_ctes(("f_device",), f"""
SELECT v.run_id, CAST(floor((epoch({AS_OF} + INTERVAL 20 MINUTE) - epoch(ts)) / 60) AS BIGINT) AS minutes_since_export,
       ts + INTERVAL 15 MINUTE AS next_export_due,
       (epoch({AS_OF} + INTERVAL 20 MINUTE) - epoch(ts)) / 60.0 <= 30 AS healthy
     , device_records, last_contact
FROM (VALUES ('{PREV_RUN_ID}', {PREV_AS_OF}), ('{RUN_ID}', {AS_OF})) v(run_id, ts),
     (SELECT COUNT(*) AS device_records, MAX(last_seen_at) AS last_contact FROM f_device)""")
    counts = "\nUNION ALL\n".join(
        f"SELECT '{n}' AS export_name, COUNT(*) AS records FROM ({ex[n]})" for n in RUN_EXPORTS)
    q["record_counts"] = counts
    q["record_totals"] = (f"SELECT CAST(SUM(records) AS BIGINT) AS total_records, COUNT(*) AS export_count "
                          f"FROM ({counts})")
    q["export_run_status"] = f"""
SELECT export_name, true AS ok, records, false AS has_error, false AS run_published FROM ({counts})
UNION ALL
SELECT 'broken_export', false, NULL, true, false"""
    codec_count = f"SELECT 'codec_scripts' AS export_name, codec_count AS records FROM ({ex['codec_count']})"
    q["list_exports"] = f"""
SELECT export_name AS name, export_name || '/snapshot={RUN_ID}' AS filename, true AS has_bytes, true AS has_files
FROM ({counts} UNION ALL {codec_count})"""
    q["manifest"] = f"SELECT export_name AS name, true AS has_files, records FROM ({counts} UNION ALL {codec_count})"
    filled = "\nUNION ALL\n".join(
        f"SELECT '{n}' AS export_name, (SELECT COUNT(*) FROM ({ex[n]})) AS records, (SELECT COUNT(*) FROM (UNPIVOT "
        f"(SELECT CAST(COLUMNS(*) AS VARCHAR) FROM ({ex[n]})) ON COLUMNS(*) INTO NAME c VALUE v) WHERE v <> '') AS filled_values"
        for n in RUN_EXPORTS)
    q["run_stats"] = f"""
SELECT '{SERVER}' AS server_name, '{EXPORT_DATE}' AS last_export, (SELECT COUNT(*) FROM ({counts})) AS exports_available,
       (SELECT records FROM ({codec_count})) AS codecs_available, d.*, g.*
FROM (SELECT COUNT(*) AS tenants, CAST(SUM(total_devices) AS BIGINT) AS total_devices,
             CAST(SUM(active_devices) AS BIGINT) AS active_devices FROM ({ex['device_summary']})) d,
     (SELECT CAST(SUM(total_gateways) AS BIGINT) AS total_gateways,
             CAST(SUM(online_gateways) AS BIGINT) AS online_gateways FROM ({ex['gateway_summary']})) g"""
    q["run_csv"] = filled
    q["run_json"] = filled
    q["fetch_export"] = f"SELECT *, COUNT(*) OVER () AS total_records FROM ({ex['tenant_user_roles']})"
    q["fetch_codec"] = f"SELECT codec_file, script_chars FROM ({q['codec_by_name']}) WHERE with_suffix ORDER BY regexp_replace(codec_file, '\\.js$', '') LIMIT 1"
    q["retention"] = with_ctes(("f_tenant", "f_gateway"), f"""
SELECT strftime(taken, '%Y%m%d_%H%M%S') AS snapshot, CAST(k + 1 AS INTEGER) AS rank, true AS keep,
       (SELECT COUNT(*) FROM f_tenant) AS tenants,
       (SELECT COUNT(*) FROM f_gateway g SEMI JOIN f_tenant t ON t.id = g.tenant_id) AS gateways,
       (SELECT COUNT(*) FROM f_gateway g SEMI JOIN f_tenant t ON t.id = g.tenant_id
        WHERE epoch(taken) - epoch(g.last_seen_at) < 300) AS online
FROM (SELECT k, {AS_OF} - to_hours(CAST(k AS INTEGER)) AS taken FROM range(10) r(k))""")
    keys_eq = "o.source_server = n.source_server AND o.device_eui = n.device_eui"
    q["upsert_devices"] = _device_snapshots() + f"""
SELECT * FROM new
UNION ALL
SELECT o.* FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE {keys_eq})"""
    q["stream_sync"] = q["upsert_devices"]
    same = " AND ".join(f"o.{c} IS NOT DISTINCT FROM n.{c}" for c in DEVICE_COLUMNS
                        if c not in ("source_server", "device_eui", "export_timestamp"))
    q["snapshot_diff"] = _device_snapshots() + f"""
SELECT COALESCE(o.device_eui, n.device_eui) AS device_eui,
       CASE WHEN o.device_eui IS NULL THEN 'added' WHEN n.device_eui IS NULL THEN 'removed'
            WHEN {same} THEN 'unchanged' ELSE 'changed' END AS change
FROM old o FULL OUTER JOIN new n ON {keys_eq}"""
    q["snapshot_changes"] = f"SELECT * FROM ({q['snapshot_diff']}) WHERE change <> 'unchanged'"
    q["kept_device_summary"] = ex["device_summary"]
    q["kept_status_breakdown"] = view_queries()["device_status_breakdown"]
    q["kept_gateway_counts"] = f"""
SELECT tenant_name, tenant_id, total_gateways, online_gateways, recent_gateways, offline_gateways
FROM ({ex['gateway_summary']}) WHERE total_gateways > 0"""
    edited = "(CASE WHEN strlen(dp.payload_codec_script) % 2 = 1 THEN dp.payload_codec_script || chr(10) || '// edited' ELSE dp.payload_codec_script END)"
    q["codec_contents"] = codec_base + f"""
SELECT {SAFE_FILENAME} AS codec_file, sha256({edited}) AS digest, CAST(strlen({edited}) + 1 AS INTEGER) AS size_bytes,
       CAST(length({edited}) AS INTEGER) AS script_chars,
       (SELECT CAST(COUNT(DISTINCT {edited}) AS INTEGER) FROM f_device_profile dp WHERE {CODEC_PREDICATE}) AS contents_left
FROM f_device_profile dp WHERE {CODEC_PREDICATE}"""
    q["reconciled_servers"] = with_ctes(DEVICES_CTES, "").rstrip() + f""",
d AS (SELECT device_eui, device_name, frame_counter_up, margin, battery_level, created_at FROM ({DEVICES_SELECT}))
SELECT *, 'current' AS source_server FROM d
UNION ALL
SELECT *, 'older' FROM d
UNION ALL
SELECT device_eui, device_name, frame_counter_up, NULL, floor(battery_level), date_trunc('day', created_at), 'oldest' FROM d"""
    q["placeholder_union"] = ex["fuota_deployments"]
    return q

"""Independent DuckDB SQL for each registered query.

Written from the definitions (fixture rules, model SQL, dashboard and
serving semantics), not from the Spark code. Views ``events`` etc. are
registered by the caller over the same parquet files.
"""

from __future__ import annotations

AS_OF_SQL = "TIMESTAMP '2024-01-30 00:00:00'"

SRC = """
src AS (
  SELECT event_id AS id,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE printf('device-%03d', user_id) END AS device_id,
    CASE WHEN event_id % 41 = 0 THEN NULL
         WHEN event_id % 53 = 0 THEN CAST(91.0 AS DOUBLE) + value
         ELSE CAST(51.5030 AS DOUBLE)
              + CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) - 50 AS DOUBLE) * CAST(0.0006 AS DOUBLE)
    END AS latitude,
    CASE WHEN event_id % 59 = 0 THEN CAST(-180.5 AS DOUBLE)
         ELSE CAST(0.0032 AS DOUBLE) + (value - CAST(50.0 AS DOUBLE)) * CAST(0.0001 AS DOUBLE) END AS longitude,
    CASE WHEN event_id % 101 = 0 THEN NULL ELSE ts END AS event_ts,
    CASE WHEN event_id % 103 = 0 THEN NULL ELSE ts + to_seconds(CAST(floor(value * 30.0) AS BIGINT)) END AS ingested_at,
    event_type, ts, user_id
  FROM events
)"""

STG = """
stg AS (
  SELECT id AS event_id, device_id, latitude, longitude, event_ts, ingested_at FROM src
)"""

# A NULL coordinate makes BETWEEN unknown, so both are asked to be true; a NULL lag isn't over the limit.
# Whole minutes since the epoch differ by the minute boundaries that lie between.
SILVER = """
tagged AS (
  SELECT *, (latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180) IS TRUE AS inside,
    (epoch_us(ingested_at) // 60000000 - epoch_us(event_ts) // 60000000 > 60) IS TRUE AS late
  FROM stg
),
silver AS (
  SELECT event_id, device_id, latitude, longitude, event_ts, ingested_at,
    if(inside, if(late, 'stale', 'ok'), 'out_of_bounds') AS severity
  FROM tagged WHERE NOT (device_id IS NULL OR event_ts IS NULL)
)"""

GOLD = """
dated AS (SELECT *, event_ts::DATE AS event_date FROM silver),
gold AS (
  SELECT device_id, event_date, count(event_id) AS event_count, avg(latitude) AS avg_latitude, avg(longitude) AS avg_longitude,
    arg_min(event_ts, event_ts) AS first_event_ts, arg_max(event_ts, event_ts) AS last_event_ts,
    count(event_id) FILTER (severity <> 'ok') AS flagged_event_count
  FROM dated GROUP BY ALL
)"""

LATEST = """
newest AS (SELECT device_id, max(struct_pack(t := event_ts, e := event_id)) AS top FROM silver GROUP BY device_id),
latest AS (
  SELECT s.device_id, s.latitude, s.longitude, s.event_ts FROM silver s JOIN newest n ON s.device_id = n.device_id AND s.event_id = n.top.e
)"""

TREND = f"""
hours AS (
  SELECT device_id, time_bucket(INTERVAL 1 HOUR, event_ts) AS event_hour FROM silver WHERE {AS_OF_SQL} - event_ts <= INTERVAL 24 HOUR
),
trend AS (SELECT device_id, event_hour, count(*) AS event_count FROM hours GROUP BY ALL)"""

# The decimal that a double's own text names.
DECIMAL = "CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,24))"
LAT, LON = DECIMAL.format(c="latitude"), DECIMAL.format(c="longitude")

ISO = ("CASE WHEN strftime({c}, '%f') = '000000' THEN strftime({c}, '%Y-%m-%dT%H:%M:%S') "
       "ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') END")

SERVING = f"""
serving AS (
  SELECT device_id, epoch_us(event_ts) // 1000 AS event_time,
    {LAT} AS latitude, {LON} AS longitude,
    {ISO.format(c='event_ts')} AS event_ts, event_id
  FROM silver
  QUALIFY row_number() OVER (PARTITION BY device_id, epoch_us(event_ts) // 1000
                             ORDER BY {ISO.format(c='event_ts')} DESC, event_id DESC) = 1
)"""

# Raw readings: routed topics only (the others carry a different suffix or depth).
ROUTED = """
routed AS (
  SELECT * FROM src WHERE NOT (id % 89 = 0 OR id % 79 = 0 OR id % 73 = 0)
)"""

ACCEPTED = """
accepted AS (
  SELECT id AS msg_id, coalesce(device_id, 'unknown') AS device_id, latitude, longitude,
    epoch_us(ts) // 1000 AS "timestamp"
  FROM routed WHERE latitude IS NOT NULL AND event_ts IS NOT NULL
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


BASE = (SRC, STG, SILVER)


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["stg_events"] = _with(SRC, STG) + "\nSELECT * FROM stg"
    q["silver_validated"] = _with(*BASE) + "\nSELECT * FROM silver"
    q["stream_silver"] = q["silver_validated"]
    q["device_daily"] = _with(*BASE, GOLD) + """
SELECT device_id, event_date, event_count, round(avg_latitude, 9) + 0.0 AS avg_latitude,
  round(avg_longitude, 9) + 0.0 AS avg_longitude, first_event_ts, last_event_ts, flagged_event_count FROM gold"""
    q["latest_position"] = _with(*BASE, LATEST) + "\nSELECT * FROM latest"
    q["hourly_trend"] = _with(*BASE, TREND) + "\nSELECT * FROM trend ORDER BY event_hour, device_id"
    q["daily_listing"] = _with(*BASE, GOLD) + """
SELECT device_id, event_date, event_count FROM gold ORDER BY event_date DESC, device_id"""
    q["top_devices"] = _with(*BASE, GOLD) + """
SELECT device_id, CAST(sum(event_count) AS BIGINT) AS event_count FROM gold
GROUP BY device_id ORDER BY event_count DESC, device_id LIMIT 10"""
    q["map_center"] = _with(*BASE, LATEST) + """
SELECT round(avg(latitude), 9) + 0.0 AS center_latitude, round(avg(longitude), 9) + 0.0 AS center_longitude
FROM latest"""
    q["active_devices"] = _with(*BASE, LATEST, TREND) + """
SELECT device_id FROM latest UNION SELECT device_id FROM trend"""
    q["device_palette"] = _with(*BASE, LATEST, TREND) + """,
ids AS (SELECT device_id FROM latest UNION SELECT device_id FROM trend),
slots AS (SELECT device_id, CAST((row_number() OVER (ORDER BY device_id) - 1) % 8 AS INTEGER) AS slot FROM ids),
coloured AS (
  SELECT device_id, slot,
    ['#2a78d6', '#1baf7a', '#eda100', '#008300', '#4a3aa7', '#e34948', '#e87ba4', '#eb6834'][slot + 1] AS color
  FROM slots)
SELECT device_id, slot, color,
  CAST(('0x' || substr(color, 2, 2)) AS INTEGER) AS red,
  CAST(('0x' || substr(color, 4, 2)) AS INTEGER) AS green,
  CAST(('0x' || substr(color, 6, 2)) AS INTEGER) AS blue
FROM coloured"""
    q["dq_not_null"] = _with(*BASE, GOLD) + """
SELECT 'not_null' AS check_name, 'iot_validated' AS model, 'event_id' AS column_name,
  CAST(count(*) FILTER (WHERE event_id IS NULL) AS BIGINT) AS failures FROM silver
UNION ALL SELECT 'not_null', 'iot_validated', 'device_id', count(*) FILTER (WHERE device_id IS NULL) FROM silver
UNION ALL SELECT 'not_null', 'iot_validated', 'event_ts', count(*) FILTER (WHERE event_ts IS NULL) FROM silver
UNION ALL SELECT 'not_null', 'device_daily', 'device_id', count(*) FILTER (WHERE device_id IS NULL) FROM gold
UNION ALL SELECT 'not_null', 'device_daily', 'event_date', count(*) FILTER (WHERE event_date IS NULL) FROM gold
UNION ALL SELECT 'not_null', 'device_daily', 'event_count', count(*) FILTER (WHERE event_count IS NULL) FROM gold"""
    q["dq_unique"] = _with(*BASE) + """
SELECT 'unique' AS check_name, 'iot_validated' AS model, 'event_id' AS column_name, count(*) AS failures
FROM (SELECT event_id FROM silver WHERE event_id IS NOT NULL GROUP BY event_id HAVING count(*) > 1)"""
    q["dq_accepted"] = _with(*BASE) + """
SELECT 'accepted_values' AS check_name, 'iot_validated' AS model, 'severity' AS column_name, count(*) AS failures
FROM (SELECT DISTINCT severity FROM silver
      WHERE severity IS NOT NULL AND severity NOT IN ('ok', 'stale', 'out_of_bounds'))"""
    q["dq_unique_combo"] = _with(*BASE, GOLD) + """
SELECT 'unique_combination' AS check_name, 'device_daily' AS model, 'device_id,event_date' AS column_name,
  count(*) AS failures
FROM (SELECT device_id, event_date FROM gold GROUP BY device_id, event_date HAVING count(*) > 1)"""
    q["dq_while_writing"] = "\nUNION ALL\n".join(f"(SELECT * FROM ({q[x]}))" for x in ("dq_unique", "dq_not_null", "dq_accepted", "dq_unique_combo"))
    q["incremental_read"] = _with(*BASE) + """
SELECT device_id, latitude, longitude, event_ts, event_id FROM silver
WHERE event_ts > TIMESTAMP '2024-01-29 00:00:00' ORDER BY event_ts, event_id"""
    q["serving_rows"] = _with(*BASE) + f"""
SELECT device_id, epoch_us(event_ts) // 1000 AS event_time,
  {LAT} AS latitude, {LON} AS longitude,
  {ISO.format(c='event_ts')} AS event_ts, event_id
FROM silver"""
    q["serving_upsert"] = _with(*BASE) + f""",
v AS (
  SELECT device_id, epoch_us(event_ts) // 1000 AS event_time,
    {LAT} AS latitude, {LON} AS longitude,
    {ISO.format(c='event_ts')} AS event_ts, event_id, CAST(1 AS BIGINT) AS batch_id FROM silver
  UNION ALL
  SELECT device_id, epoch_us(event_ts) // 1000,
    {DECIMAL.format(c='(latitude + CAST(0.001 AS DOUBLE))')}, {LON},
    {ISO.format(c='event_ts')}, event_id, CAST(2 AS BIGINT) FROM silver
  WHERE event_ts >= {AS_OF_SQL} - INTERVAL 7 DAY
)
SELECT * FROM v
QUALIFY row_number() OVER (PARTITION BY device_id, event_time ORDER BY batch_id DESC, event_ts DESC, event_id DESC) = 1"""
    q["serving_load"] = _with(*BASE) + f""",
v AS (
  SELECT device_id, epoch_us(event_ts) // 1000 AS event_time,
    {LAT} AS latitude, {LON} AS longitude,
    {ISO.format(c='event_ts')} AS event_ts, event_id,
    CAST(CASE WHEN event_ts <= TIMESTAMP '2024-01-29 00:00:00' THEN 1 ELSE 2 END AS BIGINT) AS batch_id
  FROM silver WHERE event_ts > TIMESTAMP '2024-01-28 00:00:00'
)
SELECT * FROM v
QUALIFY row_number() OVER (PARTITION BY device_id, event_time ORDER BY batch_id DESC, event_ts DESC, event_id DESC) = 1"""
    q["advance_watermark"] = _with(*BASE) + """
SELECT '__watermark__' AS device_id, CAST(0 AS BIGINT) AS event_time,
  greatest(TIMESTAMP '2024-01-29 00:00:00', max(event_ts)) AS last_event_ts
FROM silver WHERE event_ts > TIMESTAMP '2024-01-29 00:00:00'"""
    q["device_series"] = _with(*BASE, SERVING) + """
SELECT device_id, event_time, latitude, longitude, event_ts FROM serving
WHERE device_id = 'device-001' ORDER BY event_time"""
    recent = f"event_time > epoch_us({AS_OF_SQL} - INTERVAL 1 HOUR) // 1000 AND device_id <> '__watermark__'"
    q["recent_scan"] = _with(*BASE, SERVING) + f"""
SELECT device_id, event_time, latitude, longitude, event_ts FROM serving WHERE {recent}"""
    q["device_count_1h"] = _with(*BASE, SERVING) + f"""
SELECT device_id, count(*) AS event_count FROM serving WHERE {recent} GROUP BY device_id"""
    q["route_topic"] = _with(SRC, ROUTED) + """
SELECT id AS msg_id, 'iot/' || coalesce(device_id, 'device-unknown') || '/geolocation' AS topic FROM routed"""
    q["normalize_reading"] = _with(SRC, ROUTED, ACCEPTED) + "\nSELECT * FROM accepted"
    q["envelope_roundtrip"] = q["normalize_reading"]
    q["reject_readings"] = _with(SRC, ROUTED) + """
SELECT id AS msg_id, CASE WHEN latitude IS NULL THEN 'latitude' ELSE 'timestamp' END AS reject_reason
FROM routed WHERE latitude IS NULL OR event_ts IS NULL"""
    q["keyed_publish"] = _with(SRC, ROUTED, ACCEPTED) + """,
placed AS (SELECT msg_id, device_id AS key, CAST(('0x' || substr(md5(device_id), 1, 8))::BIGINT % 3 AS INTEGER) AS partition FROM accepted)
SELECT *, row_number() OVER (PARTITION BY partition ORDER BY msg_id) - 1 AS "offset" FROM placed"""
    q["ingest_events"] = _with(SRC, ROUTED, ACCEPTED) + f"""
SELECT msg_id AS id, device_id, latitude, longitude, make_timestamp("timestamp" * 1000) AS event_ts,
  {AS_OF_SQL} AS ingested_at
FROM accepted"""
    q["append_rows"] = q["ingest_events"]
    q["cdc_rejects"] = _with(SRC) + """,
images AS (
  SELECT id, event_ts FROM src UNION ALL SELECT id, event_ts FROM src WHERE id % 211 = 0)
SELECT '{"id":' || id || '}' AS key, CASE WHEN id % 401 = 0 THEN 'malformed' ELSE 'event_ts' END AS reject_reason
FROM images WHERE id % 401 = 0 OR (id % 409 = 0 AND event_ts IS NOT NULL)"""
    q["dq_broken"] = _with(SRC) + """,
s AS (
  SELECT CASE WHEN id % 71 = 0 THEN NULL WHEN id % 61 = 0 THEN id - 1 ELSE id END AS event_id, device_id, event_ts,
    CASE WHEN id % 83 = 0 THEN event_type ELSE 'ok' END AS severity FROM src),
g AS (
  SELECT device_id, event_ts::DATE AS event_date, hour(event_ts) AS h, nullif(least(count(*), 3), 3) AS event_count FROM s GROUP BY ALL)
SELECT 'unique' AS check_name, 'iot_validated' AS model, 'event_id' AS column_name,
  (SELECT count(*) FROM (SELECT event_id FROM s WHERE event_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS failures
UNION ALL SELECT 'not_null', 'iot_validated', 'event_id', count(*) - count(event_id) FROM s
UNION ALL SELECT 'not_null', 'iot_validated', 'device_id', count(*) - count(device_id) FROM s
UNION ALL SELECT 'not_null', 'iot_validated', 'event_ts', count(*) - count(event_ts) FROM s
UNION ALL SELECT 'accepted_values', 'iot_validated', 'severity', count(DISTINCT severity) FROM s WHERE severity NOT IN ('ok', 'stale', 'out_of_bounds')
UNION ALL SELECT 'not_null', 'device_daily', 'device_id', count(*) - count(device_id) FROM g
UNION ALL SELECT 'not_null', 'device_daily', 'event_date', count(*) - count(event_date) FROM g
UNION ALL SELECT 'not_null', 'device_daily', 'event_count', count(*) - count(event_count) FROM g
UNION ALL SELECT 'unique_combination', 'device_daily', 'device_id,event_date', count(*)
  FROM (SELECT 1 FROM g GROUP BY device_id, event_date HAVING count(*) > 1)"""
    q["cdc_unwrap"] = _with(SRC) + """
SELECT id, device_id, latitude, longitude, event_ts, ingested_at FROM src
UNION ALL
SELECT id, device_id, latitude + CAST(0.001 AS DOUBLE), longitude, event_ts, ingested_at FROM src WHERE id % 211 = 0
UNION ALL
SELECT CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
  CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP) FROM src WHERE id % 307 = 0"""
    q["bronze_append"] = q["cdc_unwrap"]
    bronze_cdc = """
bronze AS (
  SELECT id, device_id, latitude, longitude, event_ts, ingested_at FROM src
  UNION ALL
  SELECT id, device_id, latitude + CAST(0.001 AS DOUBLE), longitude, event_ts, ingested_at FROM src WHERE id % 211 = 0
  UNION ALL
  SELECT NULL, NULL, NULL, NULL, NULL, NULL FROM src WHERE id % 307 = 0
)"""
    silver_cdc = SILVER.replace("FROM stg", "FROM stg_cdc").replace("silver AS", "silver_cdc AS")  # and its tagged rows
    stg_cdc = """
stg_cdc AS (
  SELECT CAST(id AS BIGINT) AS event_id, device_id, latitude, longitude, event_ts, ingested_at FROM bronze
)"""
    q["silver_from_cdc"] = _with(SRC, bronze_cdc, stg_cdc, silver_cdc) + "\nSELECT * FROM silver_cdc"
    q["dq_unique_cdc"] = _with(SRC, bronze_cdc, stg_cdc, silver_cdc) + """
SELECT 'unique' AS check_name, 'iot_validated' AS model, 'event_id' AS column_name, count(*) AS failures
FROM (SELECT event_id FROM silver_cdc WHERE event_id IS NOT NULL GROUP BY event_id HAVING count(*) > 1)"""
    # The feed's last word on each id: deleted ones are gone, updated ones moved.
    current = """
bronze AS (
  SELECT id, device_id, latitude + if(id % 211 = 0, CAST(0.001 AS DOUBLE), CAST(0 AS DOUBLE)) AS latitude, longitude, event_ts, ingested_at
  FROM src WHERE id % 307 <> 0)"""
    q["cdc_current"] = _with(SRC, current) + "\nSELECT * FROM bronze"
    q["cdc_current_stream"] = q["cdc_current"]
    q["dq_unique_current"] = q["dq_unique"]
    q["distinct_readings"] = _with(*BASE) + """
SELECT * FROM silver QUALIFY row_number() OVER (PARTITION BY device_id, event_ts ORDER BY event_id) = 1"""
    q["distinct_readings_stream"] = q["distinct_readings"]
    q["device_daily_stream"] = q["device_daily"]
    q["hourly_counts_stream"] = _with(*BASE) + """
SELECT device_id, time_bucket(INTERVAL 1 HOUR, event_ts) AS event_hour, count(*) AS event_count FROM silver GROUP BY ALL"""
    q["latest_position_stream"] = q["latest_position"]
    q["topic_table"] = q["append_rows"]
    q["bucketed_series"] = q["device_series"]
    hour_cols = """strftime(t, '%Y') AS year, strftime(t, '%m') AS month, strftime(t, '%d') AS day,
  strftime(t, '%H') AS hour"""
    q["archive_hourly"] = _with(SRC, ROUTED, ACCEPTED) + f""",
clocked AS (SELECT make_timestamp("timestamp" * 1000) AS t FROM accepted)
SELECT {hour_cols}, count(*) AS record_count, true AS within_limit, true AS enough_objects FROM clocked GROUP BY ALL"""
    q["archive_restore"] = _with(SRC, ROUTED, ACCEPTED) + "\nSELECT device_id, latitude, longitude, \"timestamp\" FROM accepted"
    q["retention_14d"] = _with(SRC, ROUTED, ACCEPTED) + f""",
clocked AS (SELECT make_timestamp("timestamp" * 1000) AS t FROM accepted)
SELECT {hour_cols}, count(*) AS record_count FROM clocked
WHERE t >= {AS_OF_SQL} - INTERVAL 14 DAY GROUP BY ALL"""
    q["layer_counts"] = _with(*BASE, GOLD, SERVING, ROUTED, ACCEPTED) + """
SELECT 'iot_events' AS layer, count(*) AS row_count FROM src
UNION ALL SELECT 'stg_iot_events', count(*) FROM stg
UNION ALL SELECT 'iot_validated', count(*) FROM silver
UNION ALL SELECT 'device_daily', count(*) FROM gold
UNION ALL SELECT 'serving', count(*) FROM serving
UNION ALL SELECT 'archive_records', count(*) FROM accepted"""
    q["medallion_build"] = _with(*BASE, GOLD) + """
SELECT 'raw.stg_iot_events' AS table_name, count(*) AS row_count FROM stg
UNION ALL SELECT 'clean.iot_validated', count(*) FROM silver
UNION ALL SELECT 'analytics.device_daily', count(*) FROM gold"""
    return q

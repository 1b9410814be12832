"""Fixed values that must equal the behaviour being reproduced."""

# --- fixed values (must stay as written) -----------------------------------
# MQTT topic filter of the routing rule; '+' matches exactly one level.
GEOLOCATION_TOPIC_FILTER = "iot/+/geolocation"
# Topic names of the event stream and of the change feed.
EVENTS_TOPIC = "iot-events"
CDC_TOPIC = "cdc.iot.iot_events"
# Default device id when a reading carries none.
UNKNOWN_DEVICE = "unknown"
# Severity labels of the validated (silver) layer.
SEVERITY_OK = "ok"
SEVERITY_STALE = "stale"
SEVERITY_OUT_OF_BOUNDS = "out_of_bounds"
SEVERITY_VALUES = (SEVERITY_OK, SEVERITY_STALE, SEVERITY_OUT_OF_BOUNDS)
# Ingest lag, in minute boundaries, above which a reading is stale.
STALE_AFTER_MINUTES = 60
# Valid WGS84 ranges.
LATITUDE_RANGE = (-90.0, 90.0)
LONGITUDE_RANGE = (-180.0, 180.0)
# Serving table: key of the progress marker and first-run look-back.
WATERMARK_KEY = "__watermark__"
FIRST_RUN_LOOKBACK_HOURS = 24
# Dashboard: trailing window of the trend chart, size of the top-N chart,
# categorical palette assigned to devices in sorted order.
TREND_LOOKBACK_HOURS = 24
TOP_N_DEVICES = 10
DEVICE_PALETTE = ["#2a78d6", "#1baf7a", "#eda100", "#008300", "#4a3aa7", "#e34948", "#e87ba4", "#eb6834"]
# Serving dashboard: event count over the last hour.
RECENT_WINDOW_HOURS = 1
# Hourly JSON archive: records per file, object lifetime.
ARCHIVE_RECORDS_PER_FILE = 10
ARCHIVE_RETENTION_DAYS = 14
# Keyed publish: partitions of the event topic.
EVENT_TOPIC_PARTITIONS = 3
# Bronze sink: seconds between flushes (a flush takes all that has arrived).
BRONZE_FLUSH_SECONDS = 10
# Serving load schedule.
SERVING_LOAD_INTERVAL = "1 minute"
# Schema names of the three layers.
LAYER_SCHEMAS = {"staging": "raw", "silver": "clean", "gold": "analytics"}
# Connect JSON envelope schema of the event value (struct, all required;
# timestamp is the Connect logical Timestamp type, epoch milliseconds).
ENVELOPE_VALUE_SCHEMA_JSON = (
    '{"type":"struct","optional":false,"name":"iot.GeoLocation","fields":['
    '{"field":"device_id","type":"string","optional":false},'
    '{"field":"latitude","type":"double","optional":false},'
    '{"field":"longitude","type":"double","optional":false},'
    '{"field":"timestamp","type":"int64","optional":false,'
    '"name":"org.apache.kafka.connect.data.Timestamp","version":1}]}'
)
# ---------------------------------------------------------------------------

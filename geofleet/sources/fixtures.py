"""Fixture views over the driver's ``events`` table.

The driver ships no device data, so the inputs of every stage are derived
from ``events(event_id, ts, user_id, event_type, value, props)`` by fixed
rules. Null, out-of-range and late rows are planted by event_id residues so
each stage's edge cases occur at every scale. All rules are plain column
expressions: the views are as distributed and as lazy as the scan beneath.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geofleet.functions.time import ntz_epoch_millis
from geofleet.sources.tables import read_table

# --- fixed values: fixture planting rules (event_id residues) --------------
NULL_DEVICE_MOD = 97          # device_id NULL
NULL_LATITUDE_MOD = 41        # latitude NULL
HIGH_LATITUDE_MOD = 53        # latitude 91 + value (out of bounds)
LOW_LONGITUDE_MOD = 59        # longitude -180.5 (out of bounds)
NULL_EVENT_TS_MOD = 101       # event_ts NULL
NULL_INGESTED_MOD = 103       # ingested_at NULL
BASE_LATITUDE = 51.5030
LATITUDE_STEP = 0.0006
BASE_LONGITUDE = 0.0032
LONGITUDE_STEP = 0.0001
INGEST_LAG_SECONDS_PER_VALUE = 30
# Raw MQTT messages: topics that must not pass the routing filter.
STATUS_TOPIC_MOD = 89         # iot/<device>/status
DEEP_TOPIC_MOD = 79           # iot/<device>/geolocation/raw
FLEET_TOPIC_MOD = 73          # iot/fleet/<device>/geolocation
# Reading encodings chosen by event_type.
EPOCH_MS_EVENT_TYPE = "click"     # timestamp as epoch milliseconds
OFFSET_EVENT_TYPE = "error"       # timestamp as ISO text at +02:00
TEXT_LATITUDE_EVENT_TYPE = "view" # latitude as a JSON string
# Change feed: updated and deleted source rows.
CDC_UPDATE_MOD = 211          # a second after-image, latitude moved
CDC_DELETE_MOD = 307          # a tombstone (null value) after the row
CDC_UPDATE_LATITUDE_SHIFT = 0.001
# A damaged change feed: images cut short, and times that can't be read.
CDC_CUT_MOD = 401
CDC_BAD_TIME_MOD = 409
# A silver and a gold table that break their declared checks.
NULL_EVENT_ID_MOD = 71        # event_id NULL
REPEATED_EVENT_ID_MOD = 61    # event_id of the row before it
ODD_SEVERITY_MOD = 83         # severity = the event's type
# ----------------------------------------------------------------------------


def _device_text(user_id: Column) -> Column:
    # '%03d' pads to at least three digits; ids above 999 keep all digits.
    return F.format_string("device-%03d", user_id)


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def source_columns(ev: DataFrame) -> list[Column]:
    """Columns of the source table ``iot_events`` as expressions over ``events``."""
    eid = F.col("event_id")
    value = F.col("value")
    latitude = (
        F.when(eid % NULL_LATITUDE_MOD == 0, F.lit(None).cast("double"))
        .when(eid % HIGH_LATITUDE_MOD == 0, F.lit(91.0) + value)
        .otherwise(F.lit(BASE_LATITUDE) + (_k(F.col("props")) - 50).cast("double") * F.lit(LATITUDE_STEP))
    )
    longitude = (
        F.when(eid % LOW_LONGITUDE_MOD == 0, F.lit(-180.5))
        .otherwise(F.lit(BASE_LONGITUDE) + (value - F.lit(50.0)) * F.lit(LONGITUDE_STEP))
    )
    lag_seconds = F.floor(value * F.lit(float(INGEST_LAG_SECONDS_PER_VALUE))).cast("bigint")
    return [
        eid.alias("id"),
        F.when(eid % NULL_DEVICE_MOD == 0, F.lit(None).cast("string")).otherwise(_device_text(F.col("user_id"))).alias("device_id"),
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        F.when(eid % NULL_EVENT_TS_MOD == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("ts")).alias("event_ts"),
        F.when(eid % NULL_INGESTED_MOD == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.timestamp_add("SECOND", lag_seconds, F.col("ts"))).alias("ingested_at"),
    ]


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The relational source table (id, device_id, latitude, longitude, event_ts, ingested_at).

    It doubles as the bronze table: the change feed mirrors it 1:1.
    """
    return events_to_source(read_table(spark, sf_dir, "events"))


def events_to_source(ev: DataFrame) -> DataFrame:
    return ev.select(*source_columns(ev))


def _json_member(name: str, c: Column) -> Column:
    """'"name":<json of c>' (escaped by the JSON writer)."""
    obj = F.to_json(F.struct(c.alias(name)))
    return F.regexp_extract(obj, r"^\{(.*)\}$", 1)


def events_to_messages(ev: DataFrame) -> DataFrame:
    """Raw device messages as an MQTT broker would hand them over.

    Columns: msg_id (the message's position, like a topic offset), topic,
    payload (JSON text). Shapes covered: absent device_id, NULL latitude,
    latitude as a JSON string, epoch-ms and ISO timestamps (UTC and +02:00),
    NULL timestamp, and topics outside the routing filter.
    """
    src = ev.select("event_id", "event_type", *source_columns(ev))
    eid = F.col("event_id")
    dev = F.coalesce(F.col("device_id"), F.lit("device-unknown"))
    topic = (
        F.when(eid % STATUS_TOPIC_MOD == 0, F.concat(F.lit("iot/"), dev, F.lit("/status")))
        .when(eid % DEEP_TOPIC_MOD == 0, F.concat(F.lit("iot/"), dev, F.lit("/geolocation/raw")))
        .when(eid % FLEET_TOPIC_MOD == 0, F.concat(F.lit("iot/fleet/"), dev, F.lit("/geolocation")))
        .otherwise(F.concat(F.lit("iot/"), dev, F.lit("/geolocation")))
    )
    lat_text = F.col("latitude").cast("string")
    lat_json = (
        F.when(F.col("latitude").isNull(), F.lit("null"))
        .when(F.col("event_type") == TEXT_LATITUDE_EVENT_TYPE, F.concat(F.lit('"'), lat_text, F.lit('"')))
        .otherwise(lat_text)
    )
    ts = F.col("event_ts")
    iso_utc = F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    iso_plus2 = F.concat(
        F.date_format(F.timestamp_add("HOUR", F.lit(2), ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00")
    )
    ts_json = (
        F.when(ts.isNull(), F.lit("null"))
        .when(F.col("event_type") == EPOCH_MS_EVENT_TYPE, ntz_epoch_millis(ts).cast("string"))
        .when(F.col("event_type") == OFFSET_EVENT_TYPE, F.concat(F.lit('"'), iso_plus2, F.lit('"')))
        .otherwise(F.concat(F.lit('"'), iso_utc, F.lit('"')))
    )
    device_json = F.when(
        F.col("device_id").isNull(), F.lit("")
    ).otherwise(F.concat(_json_member("device_id", F.col("device_id")), F.lit(", ")))
    payload = F.concat(
        F.lit("{"), device_json,
        F.lit('"latitude": '), lat_json,
        F.lit(', "longitude": '), F.col("longitude").cast("string"),
        F.lit(', "timestamp": '), ts_json,
        F.lit("}"),
    )
    return src.select(eid.alias("msg_id"), topic.alias("topic"), payload.alias("payload"))


def device_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_messages(read_table(spark, sf_dir, "events"))


def _iso_zulu(c: Column) -> Column:
    return F.when(c.isNull(), None).otherwise(F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))


def source_to_cdc(src: DataFrame) -> DataFrame:
    """Change feed of the source table, already unwrapped to after-images.

    Columns: key (JSON ``{"id": n}``), value (flat JSON after-image, or NULL
    for a tombstone), position (change order). Every row is created once;
    some are updated (second image, latitude moved) and some deleted (the
    delete event is dropped by the unwrap, its tombstone kept).
    """
    key = F.to_json(F.struct(F.col("id").alias("id")))

    def image(lat: Column) -> Column:
        return F.to_json(
            F.struct(
                F.col("id").alias("id"), F.col("device_id").alias("device_id"),
                lat.alias("latitude"), F.col("longitude").alias("longitude"),
                _iso_zulu(F.col("event_ts")).alias("event_ts"),
                _iso_zulu(F.col("ingested_at")).alias("ingested_at"),
            ),
            {"ignoreNullFields": "false"},
        )

    # One pass over the source: each row yields its create, and for planted
    # rows an update image and a tombstone; explode keeps it a narrow stage.
    none = F.lit(None).cast("string")
    changes = F.array(
        F.struct(F.lit(True).alias("present"), image(F.col("latitude")).alias("value"), F.lit(0).alias("step")),
        F.struct((F.col("id") % CDC_UPDATE_MOD == 0).alias("present"),
                 image(F.col("latitude") + F.lit(CDC_UPDATE_LATITUDE_SHIFT)).alias("value"), F.lit(1).alias("step")),
        F.struct((F.col("id") % CDC_DELETE_MOD == 0).alias("present"), none.alias("value"), F.lit(2).alias("step")),
    )
    exploded = src.select(key.alias("key"), F.col("id"), F.explode(changes).alias("c")).where(F.col("c.present"))
    return exploded.select(
        "key", F.col("c.value").alias("value"), (F.col("id") * F.lit(3) + F.col("c.step")).alias("position")
    )


def cdc_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_to_cdc(events_to_source(read_table(spark, sf_dir, "events")))


def damaged_cdc_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed with some after-images cut short, and some with an event time that can't be read."""
    feed = cdc_messages(spark, sf_dir)
    row = F.get_json_object("key", "$.id").cast("bigint")
    value = F.col("value")
    return feed.withColumn("value", F.when(row % CDC_CUT_MOD == 0, F.expr("left(value, length(value) - 1)"))
                           .when(row % CDC_BAD_TIME_MOD == 0, F.regexp_replace(value, '"event_ts":"', '"event_ts":"on '))
                           .otherwise(value))


def broken_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Tables with the columns of silver and gold that break every declared check: null and repeated ids, null devices and
    times, a severity outside the list, days listed once per hour, null counts."""
    ev = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    event_id = F.when(eid % NULL_EVENT_ID_MOD == 0, None).when(eid % REPEATED_EVENT_ID_MOD == 0, eid - 1).otherwise(eid)
    severity = F.when(eid % ODD_SEVERITY_MOD == 0, F.col("event_type")).otherwise(F.lit("ok"))
    silver = ev.select(event_id.alias("event_id"), *[c for c in source_columns(ev)[1:5]], severity.alias("severity"))
    day, hour = F.col("event_ts").cast("date"), F.extract(F.lit("HOUR"), F.col("event_ts"))
    gold = silver.groupBy("device_id", day.alias("event_date"), hour.alias("h")).agg(F.count(F.lit(1)).alias("n")).select(
        "device_id", "event_date", F.when(F.col("n") < 3, F.col("n")).alias("event_count"))
    return {"iot_validated": silver, "device_daily": gold}

"""Device readings -> event topic -> relational rows.

route -> parse/normalise -> envelope -> keyed publish; and on the sink side
envelope decode -> rename -> surrogate id and ingest time. All per-row
expressions except the keyed publish, which numbers offsets by arrival.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geofleet import constants as K
from geofleet.functions.time import epoch_millis_to_ntz, ntz_literal, reading_time_to_millis
from geofleet.functions.topics import topic_filter_regex
from geofleet.operators.ranking import ordinal

# Reading fields are taken as text: a typed JSON parse gives NULL for "51.5"
# declared as double, while the bridge accepts it. Text first, then a cast.
ENVELOPE_SCHEMA = "payload STRUCT<device_id: STRING, latitude: DOUBLE, longitude: DOUBLE, timestamp: BIGINT>"

READING_COLUMNS = ["msg_id", "device_id", "latitude", "longitude", "timestamp"]
SOURCE_ROW_COLUMNS = ["id", "device_id", "latitude", "longitude", "event_ts", "ingested_at"]


def route_topic(messages: DataFrame, topic_filter: str = K.GEOLOCATION_TOPIC_FILTER) -> DataFrame:
    """Messages whose topic matches an MQTT filter ('+' = exactly one level)."""
    return messages.where(F.col("topic").rlike(topic_filter_regex(topic_filter)))


def normalise_readings(routed: DataFrame) -> DataFrame:
    """Parse and normalise each reading; keep the message and tag failures.

    device_id defaults to 'unknown' when absent (an explicit null is treated
    the same); latitude/longitude become doubles; timestamp becomes epoch ms.
    ``reject_reason`` names the first field that cannot be converted, in the
    order the bridge converts them, or is NULL for a good reading.
    """
    # A generator's output is a plan barrier: the payload is parsed once, to a VARIANT that keeps each value's JSON type,
    # and no filter above pulls the parse or the conversions into itself. Fields are taken out in a step of their own, so
    # the conversions repeat a column and not its lookup, and each step's code stays small enough to be compiled.
    parsed = routed.select("msg_id", "topic", "payload", F.explode(F.array(F.try_parse_json("payload"))).alias("_v"))
    stamp = F.try_variant_get("_v", "$.timestamp", "variant")
    is_number = F.coalesce(F.schema_of_variant(stamp).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.lit(False))
    text = lambda name: F.try_variant_get("_v", f"$.{name}", "string")
    fields = F.struct(text("device_id").alias("_device"), text("latitude").alias("_latitude"), text("longitude").alias("_longitude"),
                      text("timestamp").alias("_time"), is_number.alias("_is_number"))
    read = parsed.select("msg_id", "topic", "payload", F.inline(F.array(fields)))
    converted = F.struct(
        F.coalesce("_device", F.lit(K.UNKNOWN_DEVICE)).alias("device_id"),
        F.col("_latitude").try_cast("double").alias("latitude"),
        F.col("_longitude").try_cast("double").alias("longitude"),
        reading_time_to_millis("_time", F.col("_is_number")).alias("timestamp"),
    )
    typed = read.select("msg_id", "topic", "payload", F.inline(F.array(converted)))
    reason = (
        F.when(F.col("latitude").isNull(), F.lit("latitude"))
        .when(F.col("longitude").isNull(), F.lit("longitude"))
        .when(F.col("timestamp").isNull(), F.lit("timestamp"))
    )
    return typed.withColumn("reject_reason", reason)


def accepted_readings(normalised: DataFrame) -> DataFrame:
    return normalised.where(F.col("reject_reason").isNull()).select(*READING_COLUMNS)


def rejected_readings(normalised: DataFrame) -> DataFrame:
    return normalised.where(F.col("reject_reason").isNotNull()).select("msg_id", "topic", "payload", "reject_reason")


def envelope_value(device_id: Column, latitude: Column, longitude: Column, timestamp: Column) -> Column:
    """Connect JSON envelope ``{"schema": ..., "payload": {...}}`` as text."""
    payload = F.to_json(F.struct(
        device_id.alias("device_id"), latitude.alias("latitude"),
        longitude.alias("longitude"), timestamp.alias("timestamp"),
    ))
    return F.concat(F.lit('{"schema":' + K.ENVELOPE_VALUE_SCHEMA_JSON + ',"payload":'), payload, F.lit("}"))


def envelope(readings: DataFrame) -> DataFrame:
    """Keyed envelope records: msg_id, key (= device_id), value (JSON text), timestamp."""
    return readings.select(
        "msg_id",
        F.col("device_id").alias("key"),
        envelope_value(F.col("device_id"), F.col("latitude"), F.col("longitude"), F.col("timestamp")).alias("value"),
        "timestamp",
    )


def decode_envelope(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Payload fields of enveloped records (msg_id kept when present)."""
    keep = [c for c in ("msg_id",) if c in records.columns]
    # Parse once into a column; the field projection above it is not collapsed
    # into per-field parses because the parse is referenced several times.
    parsed = records.select(*keep, F.from_json(F.col(value_col), ENVELOPE_SCHEMA)["payload"].alias("_p"))
    return parsed.select(*keep, "_p.device_id", "_p.latitude", "_p.longitude", "_p.timestamp")


def topic_partition(key: Column, partitions: int = K.EVENT_TOPIC_PARTITIONS) -> Column:
    """Topic partition of a key: a hash of it that any engine can compute, so a device keeps its partition. No key: partition 0."""
    head = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(F.pmod(head, F.lit(partitions)), F.lit(0)).cast("int")


def keyed_publish(records: DataFrame, partitions: int = K.EVENT_TOPIC_PARTITIONS, arrival: str = "msg_id") -> DataFrame:
    """Records as a keyed topic holds them: ``partition`` by key, and ``offset`` by arrival within the partition.

    ``arrival`` is the unique, not null position in which records arrived, so per-device order is arrival
    order. The offsets are numbered by ``ordinal`` over (partition, arrival) alone: many tasks for each
    topic partition, and the payload isn't sorted. A broker assigns its own offsets
    (``sources.topics.publish``); this is the layout for a topic kept as a table.
    """
    keyed = records.withColumn("partition", topic_partition(F.col("key"), partitions))
    return ordinal(keyed, [arrival], arrival, out="offset", group="partition")


def sink_rows(readings: DataFrame, ingested_at: dt.datetime, id_base: int = 0) -> DataFrame:
    """Rows of the relational table from decoded readings.

    ``timestamp`` (epoch ms) is renamed to ``event_ts`` and converted to UTC
    NTZ; ``id`` is ``id_base`` + the message position (stable across task
    retries, unlike ``monotonically_increasing_id``); ``ingested_at`` is the
    batch's ingest time.
    """
    return readings.select(
        (F.lit(id_base).cast("bigint") + F.col("msg_id")).alias("id"),
        "device_id", "latitude", "longitude",
        epoch_millis_to_ntz(F.col("timestamp")).alias("event_ts"),
        ntz_literal(ingested_at).alias("ingested_at"),
    )

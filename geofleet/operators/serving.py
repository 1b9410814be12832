"""Serving table: keyed on (device_id, event_time), last write wins.

incremental read (event_ts > watermark) -> serving projection -> keyed upsert
-> progress marker advanced after the data. Key and range queries read the
newest version of each key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geofleet import constants as K
from geofleet.functions.time import iso_text, ntz_epoch_millis, ntz_literal

SERVING_COLUMNS = ["device_id", "event_time", "latitude", "longitude", "event_ts", "event_id"]
# Spark casts a double through its shortest decimal text, so the value is that
# text's, exactly, as long as its digits end within 24 decimal places.
COORD_DECIMAL = "decimal(38,24)"


def first_run_watermark(as_of: dt.datetime) -> dt.datetime:
    return as_of - dt.timedelta(hours=K.FIRST_RUN_LOOKBACK_HOURS)


def incremental_read(validated: DataFrame, watermark: dt.datetime | None) -> DataFrame:
    """Silver rows strictly after the watermark, in event_ts order (event_id breaks ties).

    The bound reaches the parquet scan as a pushed filter. ``None`` reads all.
    A row that arrives with an event_ts behind the mark is skipped here, as
    in any high-water-mark load; the streaming load does not have that gap.
    """
    if watermark is not None:
        validated = after_mark(validated, watermark)
    rows = validated.select("device_id", "latitude", "longitude", "event_ts", "event_id")
    return rows.orderBy("event_ts", "event_id")


def after_mark(validated: DataFrame, watermark: dt.datetime) -> DataFrame:
    """Rows with event_ts > watermark. On a date-partitioned table the implied
    ``event_date >= date(watermark)`` is added so whole days are pruned; Spark
    cannot derive it from the event_ts bound itself."""
    rows = validated.where(F.col("event_ts") > ntz_literal(watermark))
    if "event_date" in validated.columns:
        rows = rows.where(F.col("event_date") >= F.lit(watermark.date()))
    return rows


def serving_rows(rows: DataFrame) -> DataFrame:
    """Serving projection: epoch-ms sort key, exact decimal coordinates, ISO event time."""
    return rows.select(
        F.col("device_id").cast("string").alias("device_id"),
        ntz_epoch_millis("event_ts").alias("event_time"),
        F.col("latitude").cast(COORD_DECIMAL).alias("latitude"),
        F.col("longitude").cast(COORD_DECIMAL).alias("longitude"),
        iso_text("event_ts").alias("event_ts"),
        "event_id",
    )


def latest_per_key(versions: DataFrame) -> DataFrame:
    """Newest version of each (device_id, event_time).

    Order: batch_id, then event_ts text (ISO sorts chronologically), then
    event_id. Groups are single keys, so no group can grow with a device's
    volume; the shuffle spreads on the (device_id, event_time) hash.
    """
    order = [F.col("event_ts").desc(), F.col("event_id").desc()]
    if "batch_id" in versions.columns:
        order.insert(0, F.col("batch_id").desc())
    w = Window.partitionBy("device_id", "event_time").orderBy(*order)
    return versions.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def upsert(existing: DataFrame, incoming: DataFrame, batch_id: int) -> DataFrame:
    """Functional keyed upsert: existing versions + this batch, newest per key wins."""
    batch = incoming.select(*SERVING_COLUMNS).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    return latest_per_key(existing.select(*SERVING_COLUMNS, "batch_id").unionByName(batch))


def advance_watermark(batch_rows: DataFrame, watermark: dt.datetime) -> DataFrame:
    """Progress marker after a batch: greatest(old mark, newest event_ts read)."""
    return batch_rows.agg(
        F.greatest(ntz_literal(watermark), F.max("event_ts")).alias("last_event_ts")
    ).select(
        F.lit(K.WATERMARK_KEY).alias("device_id"), F.lit(0).cast("bigint").alias("event_time"), "last_event_ts"
    )


def device_series(serving: DataFrame, device_id: str) -> DataFrame:
    """Key query: every row of one device in event_time order."""
    return serving.where(F.col("device_id") == device_id).select(
        "device_id", "event_time", "latitude", "longitude", "event_ts"
    ).orderBy("event_time")


def recent_scan(serving: DataFrame, since_ms: int) -> DataFrame:
    """Filtered scan: event_time > since and not the progress marker."""
    return serving.where(
        (F.col("event_time") > F.lit(since_ms)) & (F.col("device_id") != K.WATERMARK_KEY)
    ).select("device_id", "event_time", "latitude", "longitude", "event_ts")


def device_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("device_id").agg(F.count(F.lit(1)).alias("event_count"))


def epoch_ms(value: dt.datetime) -> int:
    """Epoch ms of a naive UTC datetime (driver-side parameter conversion)."""
    return int((value - dt.datetime(1970, 1, 1)) // dt.timedelta(milliseconds=1))

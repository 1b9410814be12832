"""Streams with state: newest row per key, removal of repeats, counts by day and hour.

State lies in Spark's state store, is restored from the stream's checkpoint, and is split by key. Event time is
``event_ts`` read as UTC; a watermark needs a zoned TIMESTAMP, so one is made at the edge and dropped before the sink.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from geofleet import constants as K
from geofleet.functions.time import instant_to_ntz, ntz_epoch_micros
from geofleet.operators.medallion import GOLD_COLUMNS, daily_measures
from geofleet.operators.newest import newest
from geofleet.sources.cdc import BRONZE_COLUMNS, cdc_changes, cdc_images
from geofleet.streaming.jobs import _replace, _start

AT = "_event_instant"


def with_event_time(rows: DataFrame, delay: str) -> DataFrame:
    """``rows`` with a watermark ``delay`` behind the newest ``event_ts`` seen. Rows without a time hold it back no more than others."""
    return rows.withColumn(AT, F.timestamp_micros(ntz_epoch_micros("event_ts"))).withWatermark(AT, delay)


def newest_stream(rows: DataFrame, out: str, checkpoint: str, keys: list[str], order: list[str], columns: list[str],
                  available_now: bool = True, interval: str = K.SERVING_LOAD_INTERVAL) -> StreamingQuery:
    """The newest row per key as keyed state: each micro-batch writes the keys that it changed to a folder of its own.

    A row that arrives out of order changes nothing, however late: the state holds each key's greatest ``order``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        _replace(batch, out, batch_id)

    state = newest(rows, keys, order, columns)
    return _start(state.writeStream.outputMode("update").foreachBatch(write), checkpoint, available_now, interval).start()


def read_newest(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """What ``newest_stream`` holds now: of each key, the row of its last change."""
    changes = spark.read.parquet(out)
    return newest(changes, keys, ["batch_id"], [c for c in changes.columns if c not in (*keys, "batch_id")])


def latest_position_stream(validated: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Newest reading per device, ties on event_ts by the larger event_id."""
    return newest_stream(validated, out, checkpoint, ["device_id"], ["event_ts", "event_id"], ["latitude", "longitude", "event_ts"], available_now)


def current_images_stream(feed: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Change feed(key, value, position) -> the latest image per id; a tombstone is kept as a deleted row, so that it stays so."""
    return newest_stream(cdc_changes(cdc_images(feed)), out, checkpoint, ["id"], ["position"], ["deleted", *BRONZE_COLUMNS[1:]],
                         available_now, f"{K.BRONZE_FLUSH_SECONDS} seconds")


def read_current_images(spark: SparkSession, out: str) -> DataFrame:
    return read_newest(spark, out, ["id"]).where("not deleted").select(*BRONZE_COLUMNS)


def distinct_stream(rows: DataFrame, out: str, checkpoint: str, delay: str, keys: tuple[str, ...] = ("device_id", "event_ts"),
                    available_now: bool = True) -> StreamingQuery:
    """Rows of an at-least-once feed without repeats of ``keys``, the first to arrive kept.

    A key is remembered until the watermark is ``delay`` past its event time, and a row behind the watermark is dropped, be it a
    repeat or new. So a repeat of a row that was let through never passes, and a first arrival is lost only if it comes
    more than ``delay`` behind the newest event time. Rows without an event time are dropped: they have no place in this order.
    """
    timed = with_event_time(rows.where(F.col("event_ts").isNotNull()), delay)
    once = timed.dropDuplicatesWithinWatermark(list(keys)).drop(AT)
    return _start(once.writeStream.format("parquet").outputMode("append"), checkpoint, available_now, K.SERVING_LOAD_INTERVAL).start(out)


def _windowed(validated: DataFrame, delay: str, width: str, measures: list[Column]) -> DataFrame:
    """Measures by device and window. A row without a device counts for the watermark only (a heartbeat)."""
    # A predicate on the event time isn't pushed below the watermark, as one on the device alone would be. No time, no window.
    timed = with_event_time(validated, delay).where(F.col("device_id").isNotNull() | F.col(AT).isNull())
    return timed.groupBy("device_id", F.window(AT, width).alias("w")).agg(*measures)


def daily_stream(validated: DataFrame, out: str, checkpoint: str, delay: str, available_now: bool = True) -> StreamingQuery:
    """Gold as a stream: a device's day is written once, when the watermark passes its end. Rows behind the watermark are not counted."""
    days = _windowed(validated, delay, "1 day", daily_measures()).withColumn("event_date", instant_to_ntz("w.start").cast("date"))
    return _start(days.select(*GOLD_COLUMNS).writeStream.format("parquet").outputMode("append"), checkpoint, available_now, K.SERVING_LOAD_INTERVAL).start(out)


def hourly_stream(validated: DataFrame, out: str, checkpoint: str, delay: str, available_now: bool = True) -> StreamingQuery:
    """Events per device and hour, written once an hour is closed by the watermark."""
    hours = _windowed(validated, delay, "1 hour", [F.count(F.lit(1)).alias("event_count")])
    named = hours.select("device_id", instant_to_ntz("w.start").alias("event_hour"), "event_count")
    return _start(named.writeStream.format("parquet").outputMode("append"), checkpoint, available_now, K.SERVING_LOAD_INTERVAL).start(out)

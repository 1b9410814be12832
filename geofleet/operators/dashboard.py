"""Fleet dashboard queries over silver and gold.

All ranking, top-N and palette work stays in Spark; nothing is pulled to
the driver to be finished there.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geofleet import constants as K
from geofleet.functions.geo import hex_channel
from geofleet.functions.time import MICROS_PER_HOUR, floor_ntz, ntz_literal
from geofleet.operators.ranking import sorted_position


def latest_position(validated: DataFrame) -> DataFrame:
    """Newest reading per device (ties on event_ts broken by the larger event_id).

    ``row_number() = 1`` is planned with a partial WindowGroupLimit before the
    shuffle, so every map task forwards at most one row per device: a device
    with a third of all rows costs no more shuffle than any other.
    """
    newest_first = Window.partitionBy("device_id").orderBy(F.col("event_ts").desc(), F.col("event_id").desc())
    return (
        validated.select("device_id", "latitude", "longitude", "event_ts", "event_id")
        .withColumn("_rn", F.row_number().over(newest_first))
        .where(F.col("_rn") == 1)
        .select("device_id", "latitude", "longitude", "event_ts")
    )


def trailing_window(validated: DataFrame, as_of: dt.datetime, hours: int = K.TREND_LOOKBACK_HOURS) -> DataFrame:
    """Rows with event_ts >= as_of - hours; no upper bound (later rows count too)."""
    lower = F.timestamp_add("HOUR", F.lit(-hours), ntz_literal(as_of))
    rows = validated.where(F.col("event_ts") >= lower)
    if "event_date" in validated.columns:     # date-partitioned table: prune whole days
        rows = rows.where(F.col("event_date") >= F.lit((as_of - dt.timedelta(hours=hours)).date()))
    return rows


def hourly_trend(validated: DataFrame, as_of: dt.datetime, hours: int = K.TREND_LOOKBACK_HOURS) -> DataFrame:
    """Events per device and hour over the trailing window, ordered by hour then device."""
    return hourly_counts(validated, as_of, hours).orderBy("event_hour", "device_id")


def hourly_counts(validated: DataFrame, as_of: dt.datetime, hours: int = K.TREND_LOOKBACK_HOURS) -> DataFrame:
    """The trend's rows in no order."""
    return (
        trailing_window(validated, as_of, hours)
        .groupBy("device_id", floor_ntz("event_ts", MICROS_PER_HOUR).alias("event_hour"))
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def daily_listing(daily: DataFrame) -> DataFrame:
    """Gold rows, newest day first (device_id breaks ties)."""
    return daily.select("device_id", "event_date", "event_count").orderBy(F.col("event_date").desc(), "device_id")


def device_totals(daily: DataFrame) -> DataFrame:
    """Total events per device over all days of the gold table."""
    return daily.groupBy("device_id").agg(F.sum("event_count").cast("bigint").alias("event_count"))


def top_devices(daily: DataFrame, n: int = K.TOP_N_DEVICES) -> DataFrame:
    """Top-n devices by summed daily count (TakeOrderedAndProject: a per-partition top-n, then a merge)."""
    return device_totals(daily).orderBy(F.col("event_count").desc(), "device_id").limit(n)


def map_center(latest: DataFrame) -> DataFrame:
    """Mean position of the latest readings (NULL coordinates skipped)."""
    return latest.agg(F.avg("latitude").alias("center_latitude"), F.avg("longitude").alias("center_longitude"))


def active_devices(latest: DataFrame, trend: DataFrame) -> DataFrame:
    """Distinct device ids seen in either result."""
    return latest.select("device_id").union(trend.select("device_id")).distinct()


def devices_shown(validated: DataFrame) -> DataFrame:
    """``active_devices`` of the latest positions and the trend of one silver table, in one pass over it.

    Every silver row's device has a latest position, so the trend adds none.
    """
    return validated.select("device_id").distinct()


def device_palette(device_ids: DataFrame, palette: list[str] = K.DEVICE_PALETTE) -> DataFrame:
    """Stable colour per device: position in sorted id order modulo the palette size.

    Returns device_id, slot, color ('#rrggbb') and its red/green/blue ints.
    """
    colours = F.array(*[F.lit(c) for c in palette])
    ids = device_ids.select("device_id").where(F.col("device_id").isNotNull()).distinct()
    ranked = sorted_position(ids, "device_id", out="_pos")
    slot = F.pmod(F.col("_pos"), F.lit(len(palette))).cast("int")
    with_colour = ranked.select("device_id", slot.alias("slot")).withColumn(
        "color", F.element_at(colours, F.col("slot") + 1)
    )
    return with_colour.select(
        "device_id", "slot", "color",
        hex_channel(F.col("color"), 0).alias("red"),
        hex_channel(F.col("color"), 1).alias("green"),
        hex_channel(F.col("color"), 2).alias("blue"),
    )

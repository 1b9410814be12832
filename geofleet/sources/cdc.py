"""Change-data-capture feed of the source table.

The log reader itself is a database concern and is not built; the feed
arrives as (key, value) JSON messages whose value is the flattened
after-image of a row, or NULL for a tombstone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geofleet.functions.time import instant_to_ntz
from geofleet.operators.newest import newest

# Flattened after-image; timestamps are ISO-8601 text with a zone.
AFTER_IMAGE_SCHEMA = (
    "id BIGINT, device_id STRING, latitude DOUBLE, longitude DOUBLE, event_ts STRING, ingested_at STRING, _corrupt STRING"
)

BRONZE_COLUMNS = ["id", "device_id", "latitude", "longitude", "event_ts", "ingested_at"]


def cdc_images(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """key, position, value, BRONZE_COLUMNS and reject_reason of each change message (key and position where it has them).

    A tombstone is an all-NULL row without a reason. An image that isn't JSON
    of these types, or whose times can't be read, has a reason and may have NULL columns.
    Purely per-row (no shuffle): runs unchanged on a stream.
    """
    # One parse per message: the struct is a column of its own projection.
    options = {"columnNameOfCorruptRecord": "_corrupt"}
    keep = [c for c in ("key", "position") if c in messages.columns]
    parsed = messages.select(*keep, F.col(value_col).alias("value"), F.from_json(F.col(value_col), AFTER_IMAGE_SCHEMA, options).alias("_a"))
    timed = parsed.select(
        *keep, "value", "_a",
        instant_to_ntz(F.try_to_timestamp(F.col("_a.event_ts"))).alias("event_ts"),
        instant_to_ntz(F.try_to_timestamp(F.col("_a.ingested_at"))).alias("ingested_at"),
    )
    unread = lambda c: F.col(f"_a.{c}").isNotNull() & F.col(c).isNull()
    reason = (F.when(F.col("value").isNull(), None).when(F.col("_a").isNull() | F.col("_a._corrupt").isNotNull(), "malformed")
              .when(unread("event_ts"), "event_ts").when(unread("ingested_at"), "ingested_at"))
    return timed.select(*keep, "value", "_a.id", "_a.device_id", "_a.latitude", "_a.longitude", "event_ts", "ingested_at",
                        reason.alias("reject_reason"))


def cdc_rows(images: DataFrame) -> DataFrame:
    """Bronze rows of readable images and tombstones."""
    return images.where(F.col("reject_reason").isNull()).select(*BRONZE_COLUMNS)


def cdc_rejects(images: DataFrame) -> DataFrame:
    """Messages whose image can't be read, with the reason."""
    return images.where(F.col("reject_reason").isNotNull()).select(*[c for c in ("key", "value", "reject_reason") if c in images.columns])


def unwrap_cdc(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """After-image columns of each readable change message; a tombstone becomes an all-NULL row."""
    return cdc_rows(cdc_images(messages, value_col))


def cdc_changes(images: DataFrame) -> DataFrame:
    """id, position, deleted and the other BRONZE_COLUMNS of each readable image and tombstone, whose id is its key's.

    An image that can't be read changes nothing: the one before it stays the latest.
    """
    row = F.coalesce(F.col("id"), F.get_json_object("key", "$.id").try_cast("bigint"))
    readable = images.where(F.col("reject_reason").isNull())
    return readable.select(row.alias("id"), "position", F.col("value").isNull().alias("deleted"), *BRONZE_COLUMNS[1:]).where(F.col("id").isNotNull())


def cdc_current(messages: DataFrame) -> DataFrame:
    """The table as the feed(key, value, position) leaves it: the latest image of every id that isn't deleted."""
    latest = newest(cdc_changes(cdc_images(messages)), ["id"], ["position"], ["deleted", *BRONZE_COLUMNS[1:]])
    return latest.where("not deleted").select(*BRONZE_COLUMNS)

"""Bronze -> staging -> silver -> gold.

staging: typed 1:1 projection, no filtering.
silver:  rows without device_id or event_ts dropped, the rest tagged with a
         severity (out_of_bounds before stale before ok). Nothing else is
         dropped: late and out-of-range rows stay, tagged.
gold:    one row per (device_id, event_date) with counts, averages, first and
         last event time and the number of flagged (non-ok) rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geofleet import constants as K
from geofleet.functions.geo import severity

STAGING_COLUMNS = ["event_id", "device_id", "latitude", "longitude", "event_ts", "ingested_at"]
SILVER_COLUMNS = STAGING_COLUMNS + ["severity"]
GOLD_COLUMNS = [
    "device_id", "event_date", "event_count", "avg_latitude", "avg_longitude",
    "first_event_ts", "last_event_ts", "flagged_event_count",
]


_EPOCH_NTZ_SQL = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _ntz_sql(name: str, dtype: T.DataType) -> str:
    """SQL for a timestamp column as UTC wall-clock NTZ (zoned input converted
    zone-free through its epoch micros, NTZ kept, text parsed as an instant)."""
    if isinstance(dtype, T.TimestampNTZType):
        return name
    if isinstance(dtype, T.TimestampType):
        return f"timestampadd(MICROSECOND, unix_micros({name}), {_EPOCH_NTZ_SQL})"
    if isinstance(dtype, T.StringType):
        return f"timestampadd(MICROSECOND, unix_micros(CAST({name} AS TIMESTAMP)), {_EPOCH_NTZ_SQL})"
    return f"CAST({name} AS TIMESTAMP_NTZ)"


def staging_exprs(schema: T.StructType) -> list[str]:
    """The six staging casts as SQL expressions, for the DataFrame and the view alike."""
    return [
        "CAST(id AS BIGINT) AS event_id",
        "CAST(device_id AS STRING) AS device_id",
        "CAST(latitude AS DOUBLE) AS latitude",
        "CAST(longitude AS DOUBLE) AS longitude",
        f"{_ntz_sql('event_ts', schema['event_ts'].dataType)} AS event_ts",
        f"{_ntz_sql('ingested_at', schema['ingested_at'].dataType)} AS ingested_at",
    ]


def stage_events(bronze: DataFrame) -> DataFrame:
    """Typed staging over bronze: six casts, no filter (ANSI casts: bad input raises)."""
    return bronze.selectExpr(*staging_exprs(bronze.schema))


def validate_events(staged: DataFrame) -> DataFrame:
    """Silver: drop unattributable rows, tag the rest. Stateless, so it also runs on a stream."""
    kept = staged.where(F.col("device_id").isNotNull() & F.col("event_ts").isNotNull())
    return kept.select(
        *STAGING_COLUMNS,
        severity(F.col("latitude"), F.col("longitude"), F.col("event_ts"), F.col("ingested_at")).alias("severity"),
    )


def daily_measures() -> list[Column]:
    flagged = F.when(F.col("severity") != K.SEVERITY_OK, 1).otherwise(0)
    return [
        F.count(F.lit(1)).alias("event_count"),
        F.avg("latitude").alias("avg_latitude"),
        F.avg("longitude").alias("avg_longitude"),
        F.min("event_ts").alias("first_event_ts"),
        F.max("event_ts").alias("last_event_ts"),
        F.sum(flagged).cast("bigint").alias("flagged_event_count"),
    ]


def device_daily(validated: DataFrame) -> DataFrame:
    """Gold: daily aggregate per device.

    Two-phase hash aggregation: the partial aggregate collapses each map
    partition to one row per (device, day) before the shuffle, so a device
    holding a third of all rows still ships only a few rows per partition.
    """
    return validated.groupBy("device_id", F.col("event_ts").cast("date").alias("event_date")).agg(*daily_measures())

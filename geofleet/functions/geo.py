"""Coordinate checks, severity tagging and colour helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geofleet import constants as K
from geofleet.functions.time import minute_boundaries_between


def in_wgs84_bounds(lat: Column, lon: Column) -> Column:
    """True when both coordinates are present and inside +/-90, +/-180.

    NaN compares above every number, so a NaN coordinate is out of bounds.
    """
    lo_lat, hi_lat = K.LATITUDE_RANGE
    lo_lon, hi_lon = K.LONGITUDE_RANGE
    return ~(
        lat.isNull() | lon.isNull()
        | (lat < lo_lat) | (lat > hi_lat)
        | (lon < lo_lon) | (lon > hi_lon)
    )


def severity(lat: Column, lon: Column, event_ts: Column, ingested_at: Column) -> Column:
    """out_of_bounds is checked before stale; a NULL ingest time is never stale."""
    lag = minute_boundaries_between(event_ts, ingested_at)
    return (
        F.when(~in_wgs84_bounds(lat, lon), F.lit(K.SEVERITY_OUT_OF_BOUNDS))
        .when(lag > K.STALE_AFTER_MINUTES, F.lit(K.SEVERITY_STALE))
        .otherwise(F.lit(K.SEVERITY_OK))
    )


def hex_channel(hex_colour: Column, channel: int) -> Column:
    """Channel 0/1/2 (red/green/blue) of a '#rrggbb' colour as an int."""
    return F.conv(F.substring(hex_colour, 2 + 2 * channel, 2), 16, 10).cast("int")

"""Scalar helpers: topic filters, time arithmetic, severity edge rows."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from geofleet import constants as K
from geofleet.functions.geo import hex_channel, severity
from geofleet.functions.time import (
    MICROS_PER_HOUR,
    epoch_millis_to_ntz,
    floor_ntz,
    iso_text,
    minute_boundaries_between,
    ntz_epoch_millis,
    reading_time_to_millis,
)
from geofleet.functions.topics import topic_filter_regex
from tests.conftest import ntz


@pytest.mark.parametrize("topic,match", [
    ("iot/device-001/geolocation", True),
    ("iot//geolocation", True),            # '+' matches one (empty) level
    ("iot/a/b/geolocation", False),
    ("iot/device-001/geolocation/raw", False),
    ("iot/device-001/status", False),
    ("xiot/d/geolocation", False),
    ("iot/d/geolocationx", False),
])
def test_single_level_wildcard(topic, match):
    assert bool(re.match(topic_filter_regex("iot/+/geolocation"), topic)) is match


def test_multi_level_wildcard():
    rx = topic_filter_regex("iot/#")
    assert re.match(rx, "iot") and re.match(rx, "iot/a/b") and not re.match(rx, "iota")
    with pytest.raises(ValueError):
        topic_filter_regex("iot/#/x")


def test_minute_boundaries_vs_elapsed(spark):
    df = spark.createDataFrame(
        [(ntz("2024-01-01 00:00:59"), ntz("2024-01-01 01:01:00")),
         (ntz("2024-01-01 00:00:00"), ntz("2024-01-01 01:00:00")),
         (ntz("2024-01-01 00:00:00"), ntz("2024-01-01 01:01:00")),
         (ntz("2024-01-01 00:10:30"), ntz("2024-01-01 00:10:59")),
         (ntz("2024-01-01 00:00:00"), None)],
        "a timestamp_ntz, b timestamp_ntz",
    )
    got = [r[0] for r in df.select(minute_boundaries_between("a", "b")).collect()]
    assert got == [61, 60, 61, 0, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_reading_time_forms(spark, zone):
    ms, day = 1704067207179, 1705276800000
    cases = [("1704067207179", True, ms), ("1704067207179.9", True, ms), ("20240115", True, 20240115),
             ("2024-01-01T00:00:07.179575+00:00", False, ms), ("2024-01-01T02:00:07.179575+02:00", False, ms),
             ("2023-12-31T19:00:07.179-0500", False, ms), ("2024-01-01T05:30:07.179+05:30", False, ms),
             ("2024-01-01T00:00:07.179575Z", False, ms), ("2024-01-01T00:00:07.179575", False, ms), ("2024-01-01 00:00:07,179", False, ms),
             ("20240101T000007.179Z", False, ms), ("2024-01-15", False, day), ("20240115", False, day), ("20240115T100000Z", False, day + 36_000_000),
             ("2024-01-15T10", False, day + 36_000_000), ("1704067207179", False, None), ("2024-02-30", False, None), ("2024-01-15T25:00", False, None),
             ("not a time", False, None), ("", False, None), ("NaN", True, None), ("NaN", False, None), (None, False, None), (None, True, None)]
    df = spark.createDataFrame([(i, t, n) for i, (t, n, _) in enumerate(cases)], "i int, t string, n boolean")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = [r[0] for r in df.orderBy("i").select(reading_time_to_millis("t", F.col("n"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [want for _, _, want in cases]


def test_epoch_round_trip_and_iso(spark):
    df = spark.createDataFrame([(ntz("2024-01-01 00:00:07.179575"),), (ntz("2024-01-01 00:00:07"),)], "ts timestamp_ntz")
    out = df.select(
        ntz_epoch_millis("ts").alias("ms"), epoch_millis_to_ntz(ntz_epoch_millis("ts")).alias("back"),
        iso_text("ts").alias("iso"), floor_ntz("ts", MICROS_PER_HOUR).alias("hour"),
    ).collect()
    assert out[0].ms == 1704067207179 and out[0].back == ntz("2024-01-01 00:00:07.179")
    assert out[0].iso == "2024-01-01T00:00:07.179575" and out[1].iso == "2024-01-01T00:00:07"
    assert out[0].hour == ntz("2024-01-01 00:00:00")


def test_time_helpers_ignore_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = spark.createDataFrame([(ntz("2024-03-10 02:30:00"),)], "ts timestamp_ntz")
        r = df.select(ntz_epoch_millis("ts").alias("ms"), floor_ntz("ts", MICROS_PER_HOUR).alias("h")).first()
        assert r.ms == int((dt.datetime(2024, 3, 10, 2, 30) - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
        assert r.h == ntz("2024-03-10 02:00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("lat,lon,lag_end,expected", [
    (90.0, 180.0, "00:10:00", K.SEVERITY_OK),
    (-90.0, -180.0, "00:10:00", K.SEVERITY_OK),
    (90.000001, 0.0, "00:10:00", K.SEVERITY_OUT_OF_BOUNDS),
    (0.0, -180.5, "00:10:00", K.SEVERITY_OUT_OF_BOUNDS),
    (float("nan"), 0.0, "00:10:00", K.SEVERITY_OUT_OF_BOUNDS),
    (None, 0.0, "00:10:00", K.SEVERITY_OUT_OF_BOUNDS),
    (91.0, 0.0, "05:00:00", K.SEVERITY_OUT_OF_BOUNDS),   # bounds win over staleness
    (51.5, 0.0, "01:00:00", K.SEVERITY_OK),              # exactly 60 minutes
    (51.5, 0.0, "01:01:00", K.SEVERITY_STALE),           # 61 boundaries
    (51.5, 0.0, None, K.SEVERITY_OK),                    # no ingest time: never stale
])
def test_severity_edges(spark, lat, lon, lag_end, expected):
    ing = ntz(f"2024-01-01 {lag_end}") if lag_end else None
    df = spark.createDataFrame([(lat, lon, ntz("2024-01-01 00:00:00"), ing)],
                               "lat double, lon double, ts timestamp_ntz, ing timestamp_ntz")
    assert df.select(severity(F.col("lat"), F.col("lon"), F.col("ts"), F.col("ing"))).first()[0] == expected


def test_stale_boundary_pair(spark):
    df = spark.createDataFrame([(51.5, 0.0, ntz("2024-01-01 00:00:59"), ntz("2024-01-01 01:01:00"))],
                               "lat double, lon double, ts timestamp_ntz, ing timestamp_ntz")
    assert df.select(severity(F.col("lat"), F.col("lon"), F.col("ts"), F.col("ing"))).first()[0] == K.SEVERITY_STALE


def test_hex_channels(spark):
    r = spark.createDataFrame([("#2a78d6",)], "c string").select(
        *[hex_channel(F.col("c"), i) for i in range(3)]).first()
    assert tuple(r) == (0x2A, 0x78, 0xD6)

"""Staging, silver and gold on hand-written bronze rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from geofleet.operators.medallion import GOLD_COLUMNS, SILVER_COLUMNS, device_daily, stage_events, validate_events
from tests.conftest import ntz

BRONZE = "id bigint, device_id string, latitude double, longitude double, event_ts timestamp_ntz, ingested_at timestamp_ntz"


def bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE)


def test_silver_drops_unattributable_and_tags(spark):
    t = ntz("2024-01-01 10:00:00")
    rows = [
        (1, "d1", 51.5, 0.1, t, t + dt.timedelta(minutes=5)),
        (2, None, 51.5, 0.1, t, t),                              # dropped: no device
        (3, "d1", 51.5, 0.1, None, t),                           # dropped: no event time
        (4, "d1", 95.0, 0.1, t, t),                              # out_of_bounds
        (5, "d2", 51.5, 0.1, t, t + dt.timedelta(hours=2)),      # stale
        (6, "d2", None, 0.1, t, t + dt.timedelta(hours=2)),      # null coordinate: out_of_bounds first
    ]
    s = validate_events(stage_events(bronze(spark, rows)))
    assert s.columns == SILVER_COLUMNS
    got = {r.event_id: r.severity for r in s.collect()}
    assert got == {1: "ok", 4: "out_of_bounds", 5: "stale", 6: "out_of_bounds"}


def test_staging_converts_zoned_input_to_utc(spark):
    df = spark.createDataFrame([("7", "d", "51.5", "0.1", "2024-01-01T10:00:00+02:00", "2024-01-01T08:30:00Z")],
                               "id string, device_id string, latitude string, longitude string, "
                               "event_ts string, ingested_at string")
    r = stage_events(df).first()
    assert r.event_id == 7 and r.latitude == 51.5
    assert r.event_ts == ntz("2024-01-01 08:00:00") and r.ingested_at == ntz("2024-01-01 08:30:00")


def test_gold_daily_aggregate(spark):
    t = ntz("2024-01-01 23:59:00")
    rows = [
        (1, "d1", 50.0, 1.0, t, t),
        (2, "d1", 52.0, 3.0, t - dt.timedelta(hours=1), t),
        (3, "d1", 100.0, 3.0, t + dt.timedelta(minutes=2), t + dt.timedelta(minutes=2)),   # next day, oob
        (4, "d1", None, 2.0, t - dt.timedelta(hours=2), t + dt.timedelta(hours=5)),         # oob (null lat)
    ]
    g = device_daily(validate_events(stage_events(bronze(spark, rows)))).orderBy("event_date")
    assert g.columns == GOLD_COLUMNS
    day1, day2 = g.collect()
    assert day1.event_date == dt.date(2024, 1, 1) and day1.event_count == 3
    assert day1.avg_latitude == 51.0 and day1.avg_longitude == 2.0          # null latitude skipped
    assert day1.first_event_ts == t - dt.timedelta(hours=2) and day1.last_event_ts == t
    assert day1.flagged_event_count == 1
    assert day2.event_count == 1 and day2.flagged_event_count == 1


def test_gold_partial_aggregation_in_plan(spark):
    t = ntz("2024-01-01 00:00:00")
    g = device_daily(validate_events(stage_events(bronze(spark, [(1, "d", 1.0, 1.0, t, t)]))))
    plan = g._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2      # partial before the shuffle, final after

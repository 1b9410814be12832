"""Dashboard operators against brute force on small inputs."""

from __future__ import annotations

import datetime as dt

from geofleet import constants as K
from geofleet.operators import dashboard as D
from geofleet.operators.ranking import sorted_position
from tests.conftest import ntz

SILVER = ("event_id bigint, device_id string, latitude double, longitude double, event_ts timestamp_ntz, "
          "ingested_at timestamp_ntz, severity string")


def test_sorted_position_matches_python_sort(spark):
    ids = [f"dev-{(i * 7919) % 1000:04d}" for i in range(1000)]
    df = spark.createDataFrame([(i,) for i in ids], "device_id string")
    got = {r.device_id: r.position for r in sorted_position(df, "device_id", partitions=7).collect()}
    assert got == {d: i for i, d in enumerate(sorted(ids))}


def test_palette_slots(spark):
    ids = [f"device-{i:03d}" for i in range(20)][::-1]
    pal = {r.device_id: r for r in D.device_palette(spark.createDataFrame([(i,) for i in ids], "device_id string")).collect()}
    for i, d in enumerate(sorted(ids)):
        assert pal[d].slot == i % 8 and pal[d].color == K.DEVICE_PALETTE[i % 8]
    assert (pal["device-000"].red, pal["device-000"].green, pal["device-000"].blue) == (0x2A, 0x78, 0xD6)


def test_latest_trend_and_top(spark):
    t = ntz("2024-01-29 12:00:00")
    rows = [(1, "a", 1.0, 1.0, t, t, "ok"), (2, "a", 2.0, 2.0, t, t, "ok"),               # tie on ts: larger id wins
            (3, "b", 3.0, 3.0, t - dt.timedelta(days=3), t, "ok"),
            (4, "b", 4.0, 4.0, t + dt.timedelta(days=5), t, "stale")]                     # future rows count
    s = spark.createDataFrame(rows, SILVER)
    latest = {r.device_id: r.latitude for r in D.latest_position(s).collect()}
    assert latest == {"a": 2.0, "b": 4.0}
    trend = D.hourly_trend(s, ntz("2024-01-30 00:00:00")).collect()
    assert [(r.device_id, r.event_hour, r.event_count) for r in trend] == \
        [("a", ntz("2024-01-29 12:00:00"), 2), ("b", ntz("2024-02-03 12:00:00"), 1)]
    daily = spark.createDataFrame([("a", 5), ("b", 5), ("c", 7), ("a", 1)], "device_id string, event_count bigint")
    assert [(r.device_id, r.event_count) for r in D.top_devices(daily, n=2).collect()] == [("c", 7), ("a", 6)]

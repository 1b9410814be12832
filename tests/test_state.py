"""Streams with state against batch results, over restarts, replays and rows out of order."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from geofleet.operators import dashboard as D
from geofleet.operators.medallion import device_daily
from geofleet.operators.newest import distinct_rows, newest
from geofleet.plans import catalog as C
from geofleet.sources.cdc import BRONZE_COLUMNS, cdc_current
from geofleet.streaming import jobs as J
from geofleet.streaming import state as W
from tests.conftest import ntz

SILVER = "event_id bigint, device_id string, latitude double, longitude double, event_ts timestamp_ntz, ingested_at timestamp_ntz, severity string"
BASE = ntz("2024-01-10 00:00:00")


def silver(spark, rows):
    """rows: (event_id, device_id, hours after the base, or None)."""
    made = [(i, d, float(i), 0.5, None if h is None else BASE + dt.timedelta(hours=h), BASE, "ok" if i % 3 else "stale") for i, d, h in rows]
    return spark.createDataFrame(made, SILVER)


def same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    return sorted(map(repr, a.select(cols).collect())) == sorted(map(repr, b.select(cols).collect()))


def feed(spark, root, rows):
    rows.write.mode("append").parquet(f"{root}/feed")
    return J.table_stream(spark, f"{root}/feed")


def test_newest_combines_before_the_shuffle(spark):
    plan = newest(silver(spark, [(1, "a", 1)]), ["device_id"], ["event_ts", "event_id"], ["latitude"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and plan.index("max_by") < plan.index("Exchange") < plan.index("partial_max_by")


def image(i, lat):
    return '{"id":%d,"device_id":"d","latitude":%s,"longitude":1.0,"event_ts":"2024-01-01T00:00:00Z","ingested_at":null}' % (i, lat)


def test_current_images(spark, workdir):
    feed_schema = "key string, value string, position bigint"
    first = [('{"id":1}', image(1, 1.0), 0), ('{"id":2}', image(2, 1.0), 1), ('{"id":3}', image(3, 1.0), 2), ('{"id":1}', image(1, 2.0), 5)]
    # an old image that comes late, a delete, a deleted row made again, an image cut short, messages without a key
    second = [('{"id":1}', image(1, 9.0), 4), ('{"id":2}', None, 7), ('{"id":3}', image(3, 5.0)[:-1], 8), (None, image(4, 4.0), 9), (None, None, 10)]
    third = [('{"id":2}', image(2, 3.0), 11), ('{"id":4}', None, 12), ('{"id":5}', image(5, 1.0), 13), ('{"id":2}', None, 6)]
    seen = []
    for part, want in ((first, {1: 2.0, 2: 1.0, 3: 1.0}), (second, {1: 2.0, 3: 1.0, 4: 4.0}), (third, {1: 2.0, 2: 3.0, 3: 1.0, 5: 1.0})):
        seen += part
        batch = cdc_current(spark.createDataFrame(seen, feed_schema))
        W.current_images_stream(feed(spark, workdir, spark.createDataFrame(part, feed_schema)), f"{workdir}/out", f"{workdir}/ck").awaitTermination()
        now = W.read_current_images(spark, f"{workdir}/out")
        assert now.columns == batch.columns == BRONZE_COLUMNS
        assert {r.id: r.latitude for r in batch.collect()} == want and same(now, batch)


def test_latest_position_after_each_batch(spark, workdir):
    parts = [[(1, "a", 5), (2, "a", 3), (3, "b", 1)], [(4, "a", 4), (5, "b", 1), (6, "c", 0)], [(7, "a", 5), (8, "a", -999), (9, "c", 7)]]
    seen = []
    for part in parts:
        seen += part
        W.latest_position_stream(feed(spark, workdir, silver(spark, part)), f"{workdir}/out", f"{workdir}/ck").awaitTermination()
        assert same(W.read_newest(spark, f"{workdir}/out", ["device_id"]), D.latest_position(silver(spark, seen)))


def test_repeats_are_removed_within_and_across_batches(spark, workdir):
    parts = [[(1, "a", 1), (2, "a", 2), (2, "a", 2), (3, None, 2), (4, "b", None)], [(1, "a", 1), (2, "a", 2), (5, "a", 40), (3, None, 2)],
             [(1, "a", 1), (5, "a", 40), (6, "b", 10), (7, "b", 39)]]
    for part in parts:
        W.distinct_stream(feed(spark, workdir, silver(spark, part)), f"{workdir}/out", f"{workdir}/ck", "6 hours").awaitTermination()
    got = sorted(r.event_id for r in spark.read.parquet(f"{workdir}/out").collect())
    # 4 has no time; 6 is new, but more than six hours behind the newest event when it arrives: its stated fate is to be dropped
    assert got == [1, 2, 3, 5, 7]
    batch = distinct_rows(silver(spark, [r for p in parts for r in p]), ["device_id", "event_ts"], ["event_id"])
    assert sorted(r.event_id for r in batch.collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_days_and_hours_close_once_and_equal_batch(spark, workdir):
    parts = [[(1, "a", 1), (2, "a", 23.5), (3, "b", 2)], [(4, "a", 23.9), (5, "a", 25), (6, "b", 24)], [(7, "a", 30), (8, "b", 47.9)]]
    days = lambda: spark.read.parquet(f"{workdir}/days")
    closed = []
    for n, part in enumerate([*parts, [(99, None, 90)]]):
        rows = feed(spark, workdir, silver(spark, part))
        W.daily_stream(rows, f"{workdir}/days", f"{workdir}/ck1", "1 hour").awaitTermination()
        W.hourly_stream(rows, f"{workdir}/hours", f"{workdir}/ck2", "1 hour").awaitTermination()
        closed.append(days().count())
    # the first day is open until an event an hour past its end; the second until the heartbeat
    assert closed == [0, 2, 2, 4]
    whole = silver(spark, [r for p in parts for r in p])
    assert same(days(), device_daily(whole))
    assert same(spark.read.parquet(f"{workdir}/hours"), D.hourly_counts(whole, BASE))
    # a row behind the watermark is not counted any more
    rows = feed(spark, workdir, silver(spark, [(50, "a", 2)]))
    W.daily_stream(rows, f"{workdir}/days", f"{workdir}/ck1", "1 hour").awaitTermination()
    assert same(days(), device_daily(whole))


def test_replayed_feed_repeats_rows_in_every_slice(spark):
    from tests.conftest import SF_SMALL

    slices = C.replayed(C.silver(spark, SF_SMALL))
    counts = [s.count() for s in slices]
    assert len(slices) == len(C.SLICE_DAYS_AGO) + 1 and all(counts)
    assert sum(counts) > 1.2 * C.silver(spark, SF_SMALL).count()
    assert slices[-1].where(F.col("event_ts") < F.lit(C.AS_OF - dt.timedelta(days=21)).cast("timestamp_ntz")).count() > 0

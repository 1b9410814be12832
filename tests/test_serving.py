"""Serving table: projection, last write wins, incremental loads and restarts."""

from __future__ import annotations

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from geofleet.functions.time import ntz_literal
from geofleet.operators import serving as S
from geofleet.plans.serving_job import ServingStore, load_epoch, load_increment
from tests.conftest import ntz

SILVER = ("event_id bigint, device_id string, latitude double, longitude double, event_ts timestamp_ntz, "
          "ingested_at timestamp_ntz, severity string")


def silver(spark, rows):
    return spark.createDataFrame([(i, d, la, lo, ts, ts, "ok") for i, d, la, lo, ts in rows], SILVER)


def test_projection(spark):
    s = silver(spark, [(1, "d1", 51.5036, -0.000569, ntz("2024-01-01 00:00:07.179575"))])
    r = S.serving_rows(s).first()
    assert r.event_time == 1704067207179 and r.event_ts == "2024-01-01T00:00:07.179575"
    assert r.latitude == decimal.Decimal("51.5036") and r.longitude == decimal.Decimal("-0.000569")


def test_last_write_wins(spark):
    t = ntz("2024-01-01 00:00:00.100")
    s = silver(spark, [(1, "d1", 1.0, 1.0, t), (2, "d1", 2.0, 1.0, t + dt.timedelta(microseconds=500)),  # same ms
                       (3, "d2", 3.0, 1.0, t)])
    first = S.serving_rows(s).withColumn("batch_id", F.lit(1).cast("bigint"))
    snap = {(r.device_id, r.event_time): r for r in S.latest_per_key(first).collect()}
    assert snap[("d1", 1704067200100)].event_id == 2          # newer event_ts inside one batch wins
    again = S.serving_rows(silver(spark, [(3, "d2", 9.0, 1.0, t)]))
    upd = {(r.device_id, r.event_time): r for r in S.upsert(first, again, batch_id=2).collect()}
    assert upd[("d2", 1704067200100)].latitude == decimal.Decimal("9") and len(upd) == 2


def test_watermark_marker(spark):
    wm = ntz("2024-01-01 00:00:00")
    s = silver(spark, [(1, "d1", 1.0, 1.0, ntz("2024-01-01 05:00:00"))])
    r = S.advance_watermark(S.incremental_read(s, wm), wm).first()
    assert (r.device_id, r.event_time, r.last_event_ts) == ("__watermark__", 0, ntz("2024-01-01 05:00:00"))
    empty = S.advance_watermark(S.incremental_read(s, ntz("2024-02-01 00:00:00")), ntz("2024-02-01 00:00:00")).first()
    assert empty.last_event_ts == ntz("2024-02-01 00:00:00")


def test_incremental_loads_and_restart(spark, workdir):
    base = ntz("2024-01-10 00:00:00")
    rows = [(i, f"d{i % 2}", float(i), 0.0, base + dt.timedelta(hours=i)) for i in range(1, 11)]
    s = silver(spark, rows)
    store = ServingStore(spark, f"{workdir}/serving")
    as_of1 = base + dt.timedelta(hours=5)
    # run 1 sees only rows that had arrived by as_of1; first-run look-back is 24 h
    assert load_increment(store, s.where(F.col("event_ts") <= ntz_literal(as_of1)), as_of1, 1)
    assert store.table().count() == 5 and store.watermark() == as_of1
    # crash after data, before the marker: replaying batch 2 must not duplicate
    newer = s.where(F.col("event_ts") > ntz_literal(as_of1))
    store.write_batch(S.serving_rows(newer), 2)
    assert load_increment(store, s, base + dt.timedelta(hours=12), 2)
    assert store.table().where("batch_id = 2").count() == 5
    assert not load_increment(store, s, base + dt.timedelta(hours=12), 2)     # repeated trigger: no-op
    assert load_increment(store, s, base + dt.timedelta(hours=12), 3)         # nothing new: writes zero rows
    assert store.table().where("batch_id = 3").count() == 0
    assert store.table().count() == 10 and store.watermark() == base + dt.timedelta(hours=10)
    series = S.device_series(store.table(), "d1").collect()
    assert [r.event_time for r in series] == sorted(r.event_time for r in series) and len(series) == 5


def test_late_row_skipped_by_high_water_mark(spark):
    s = silver(spark, [(1, "d", 1.0, 1.0, ntz("2024-01-01 10:00:00")), (2, "d", 1.0, 1.0, ntz("2024-01-01 09:00:00"))])
    assert S.incremental_read(s, ntz("2024-01-01 09:30:00")).count() == 1


def loaded(spark, root):
    """A store with two days of two devices each."""
    base = ntz("2024-01-10 00:00:00")
    store = ServingStore(spark, root)
    store.write_batch(S.serving_rows(silver(spark, [(i, f"d{i % 2}", float(i), 0.0, base + dt.timedelta(hours=12 * i)) for i in range(4)])), 1)
    store.commit(1, base)
    return store, base


def contents(store):
    return sorted((r.event_id, r.batch_id, float(r.latitude)) for r in store.table().collect())


def test_a_load_replaces_the_days_that_it_touches_only(spark, workdir):
    import glob
    import os

    store, base = loaded(spark, f"{workdir}/serving")
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{store.root}/table/event_date=2024-01-11/*.parquet")}
    before = files()
    # a late key, far behind the mark, and a newer version of a key of the same day
    late = silver(spark, [(9, "d9", 9.0, 0.0, base + dt.timedelta(hours=1)), (10, "d1", 7.0, 0.0, base + dt.timedelta(hours=12))])
    assert load_epoch(store, late, "s#0")
    assert contents(store) == [(0, 1, 0.0), (2, 1, 2.0), (3, 1, 3.0), (9, 2, 9.0), (10, 2, 7.0)]
    assert before and files() == before
    assert not os.path.exists(store._pending(2)) and store.watermark() == base + dt.timedelta(hours=36)


@pytest.mark.parametrize("point", ["pending", "commit", "replace"])
def test_a_load_that_dies_is_made_anew_or_finished(spark, workdir, monkeypatch, point):
    store, base = loaded(spark, f"{workdir}/serving")
    wrong = silver(spark, [(50, "x", 1.0, 1.0, base)])
    good = silver(spark, [(i, f"d{i % 2}", 20.0, 0.0, base + dt.timedelta(hours=12 * i)) for i in range(2, 6)])

    def die(*_):
        raise RuntimeError("dead")

    if point == "pending":                     # other rows pending, not committed: replaced
        store.write_batch(S.serving_rows(wrong), 2)
        assert len(contents(store)) == 4
        assert load_epoch(store, good, "s#0")
    elif point == "commit":                    # committed, but no day replaced yet: the next writer finishes it
        with monkeypatch.context() as m:
            m.setattr(ServingStore, "_replace_days", die)
            with pytest.raises(RuntimeError):
                load_epoch(store, good, "s#0")
        assert len(contents(store)) == 4
        assert not load_epoch(store, good, "s#0")
    else:                                      # days replaced, pending still there: replacing them again changes nothing
        with monkeypatch.context() as m:
            m.setattr("geofleet.plans.serving_job.delete_folders", die)
            with pytest.raises(RuntimeError):
                load_epoch(store, good, "s#0")
        assert load_epoch(store, silver(spark, []), "s#1")
    assert contents(store) == [(0, 1, 0.0), (1, 1, 1.0), (2, 2, 20.0), (3, 2, 20.0), (4, 2, 20.0), (5, 2, 20.0)]


def test_key_query_reads_one_bucket(spark, workdir):
    store, _ = loaded(spark, f"{workdir}/serving")
    # Files of other buckets are passed over in any case; the plan names the buckets only where the scan keeps them as partitions.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        plan = store.series("d1")._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 8" in plan and "EqualTo(device_id,d1)" in plan
    assert [r.event_time for r in store.series("d1").collect()] == [S.epoch_ms(ntz("2024-01-10 12:00:00")), S.epoch_ms(ntz("2024-01-11 12:00:00"))]


def test_another_catalog_finds_the_table_by_its_place(spark, workdir):
    store, _ = loaded(spark, f"{workdir}/serving")
    again = ServingStore(spark, store.root, name="serving_seen_elsewhere")
    assert contents(again) == contents(store) and len(contents(again)) == 4


def test_decimals_are_the_doubles_own_text(spark):
    values = [51.5036, 0.1 + 0.2, -0.000569, 1e-7, 179.99999999999997, 5e-324, None]
    s = silver(spark, [(i, f"d{i}", v, v, ntz("2024-01-01 00:00:00")) for i, v in enumerate(values)])
    got = {r.event_id: r.latitude for r in S.serving_rows(s).collect()}
    for i, v in enumerate(values):
        if v is None:
            assert got[i] is None
        elif abs(v) > 1e-8:
            assert got[i] == decimal.Decimal(repr(v))
    assert got[5] == 0       # digits beyond 24 places


def test_retry_leaves_nothing_of_a_dead_attempt(spark, workdir):
    days = [ntz("2024-01-10 00:00:00"), ntz("2024-01-11 00:00:00")]
    first = silver(spark, [(i, f"d{i}", 1.0, 1.0, days[0]) for i in range(5)])
    second = silver(spark, [(i, f"d{i}", 2.0, 1.0, days[1]) for i in range(3)])
    store = ServingStore(spark, f"{workdir}/serving")
    store.write_batch(S.serving_rows(first), 1)
    assert store.table().count() == 0                      # not committed, not visible
    store.write_batch(S.serving_rows(second), 1)
    store.commit(1, days[0])
    assert store.table().count() == 3 and store.progress().first().rows_written == 3


def test_batch_ids_only_grow(spark, workdir):
    day = ntz("2024-01-10 00:00:00")
    rows = [S.serving_rows(silver(spark, [(i, f"d{i}", 1.0, 1.0, day) for i in range(k, k + 8)])) for k in (0, 8)]
    store = ServingStore(spark, f"{workdir}/serving")
    store.write_batch(rows[0], 6)
    store.commit(6, day)
    with pytest.raises(ValueError, match="isn't after the newest"):
        store.write_batch(rows[1], 0)
    assert load_epoch(store, silver(spark, [(i, f"d{i}", 1.0, 1.0, day) for i in range(8, 15)]), "stream#0")
    assert not load_epoch(store, silver(spark, [(99, "x", 1.0, 1.0, day)]), "stream#0")   # a replayed epoch
    assert store.table().count() == 15
    assert {(r.batch_id, r.source) for r in store.progress().collect()} == {(6, None), (7, "stream#0")}


def test_other_errors_than_a_missing_path_are_raised(spark, workdir):
    store = ServingStore(spark, f"nosuchscheme://{workdir}/serving")
    with pytest.raises(Exception, match="nosuchscheme"):
        store.watermark()

"""Physical-plan properties that matter at scale: pushdown, pruning, partial work."""

from __future__ import annotations

import datetime as dt
import re

from geofleet.operators import dashboard as D
from geofleet.operators import serving as S
from geofleet.plans.catalog import accepted, archive_records, normalised, silver
from geofleet.plans.medallion_build import build_medallion
from geofleet.plans.serving_job import ServingStore, load_increment
from geofleet.sources.fixtures import source_events
from tests.conftest import SF_SMALL, ntz


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_incremental_read_pushes_bound_into_silver_scan(spark, workdir):
    source_events(spark, SF_SMALL).write.parquet(f"{workdir}/bronze")
    names = build_medallion(spark, f"{workdir}/bronze", f"{workdir}/wh")
    rows = S.incremental_read(spark.table(names["silver"]), ntz("2024-01-29 00:00:00"))
    p = plan(rows)
    assert "PushedFilters: [IsNotNull(event_ts), GreaterThan(event_ts," in p
    assert "PartitionFilters: [isnotnull(event_date" in p and "2024-01-29" in p
    trend = plan(D.hourly_trend(spark.table(names["silver"]), ntz("2024-01-30 00:00:00")))
    assert "PartitionFilters: [isnotnull(event_date" in trend
    # column pruning: severity and ingested_at are not read
    assert "ReadSchema: struct<event_id:bigint,device_id:string,latitude:double,longitude:double,event_ts:timestamp_ntz>" in p


def test_store_key_and_range_reads_are_pruned(spark, workdir):
    store = ServingStore(spark, f"{workdir}/store")
    load_increment(store, silver(spark, SF_SMALL), dt.datetime(2024, 1, 30), 1)
    series = plan(store.series("device-001"))
    assert "EqualTo(device_id,device-001)" in series            # below the newest-version window
    recent = plan(store.recent(S.epoch_ms(dt.datetime(2024, 1, 29, 23))))
    assert "PartitionFilters: [isnotnull(event_date" in recent and "2024-01-29" in recent
    assert store.recent(S.epoch_ms(dt.datetime(2024, 1, 29, 23))).count() == \
        S.recent_scan(store.table(), S.epoch_ms(dt.datetime(2024, 1, 29, 23))).count()


def test_top1_per_device_limits_before_shuffle(spark):
    p = plan(D.latest_position(silver(spark, SF_SMALL)))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_top_n_is_take_ordered(spark):
    from geofleet.operators.medallion import device_daily
    p = plan(D.top_devices(device_daily(silver(spark, SF_SMALL))))
    assert "TakeOrderedAndProject" in p


def exchanges(df) -> int:
    return sum("Exchange " in line and "ReusedExchange" not in line for line in plan(df).splitlines())


def scans(df) -> int:
    return plan(df).count("FileScan")


def test_no_global_sort_under_the_serving_queries(spark):
    from geofleet.plans import catalog as C

    assert exchanges(C.q_serving_rows(spark, SF_SMALL)) == 0
    snapshot = C.serving_snapshot(spark, SF_SMALL)
    assert exchanges(snapshot) == 1 and "rangepartitioning" not in plan(snapshot)
    assert exchanges(C.q_device_count_1h(spark, SF_SMALL)) <= 2


def test_devices_are_found_in_one_scan(spark):
    from geofleet.plans import catalog as C

    shown = C.q_active_devices(spark, SF_SMALL)
    assert scans(shown) == 1 and exchanges(shown) == 1
    s = silver(spark, SF_SMALL)
    union = D.active_devices(D.latest_position(s), D.hourly_counts(s, C.AS_OF))
    assert {r.device_id for r in shown.collect()} == {r.device_id for r in union.collect()}


def test_a_table_is_read_once_for_its_column_checks(spark, workdir):
    from geofleet.operators import quality as Q
    from geofleet.operators.medallion import device_daily

    silver(spark, SF_SMALL).write.parquet(f"{workdir}/silver")
    s = spark.read.parquet(f"{workdir}/silver")
    device_daily(s).write.parquet(f"{workdir}/gold")
    checks = Q.run_checks({"iot_validated": s, "device_daily": spark.read.parquet(f"{workdir}/gold")})
    assert scans(checks) == 4       # of each table, one for the columns and one for the key


def test_reading_conversions_stay_small_enough_to_be_compiled(spark, capsys):
    normalised(spark, SF_SMALL).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000                      # the JVM interprets longer methods


def test_archive_records_are_dealt_before_they_are_parsed(spark):
    records = archive_records(spark, SF_SMALL)
    p = plan(records)
    assert "REBALANCE_PARTITIONS" in p and p.rindex("Generate ") < p.index("REBALANCE_PARTITIONS")
    assert sorted(r.msg_id for r in records.collect()) == sorted(r.msg_id for r in accepted(spark, SF_SMALL).collect())

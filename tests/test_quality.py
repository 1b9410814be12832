"""Data-quality checks: all pass on the fixture, each fails on a planted defect."""

from __future__ import annotations

import datetime as dt

from geofleet.operators import quality as Q
from geofleet.operators.medallion import device_daily
from geofleet.plans.catalog import silver
from tests.conftest import SF_SMALL, ntz

SILVER = ("event_id bigint, device_id string, latitude double, longitude double, event_ts timestamp_ntz, "
          "ingested_at timestamp_ntz, severity string")


def results(df):
    return {(r.check_name, r.model, r.column_name): r.failures for r in df.collect()}


def test_all_pass_on_fixture(spark):
    s = silver(spark, SF_SMALL)
    res = results(Q.run_checks({"iot_validated": s, "device_daily": device_daily(s)}))
    assert len(res) == 9 and all(v == 0 for v in res.values())


def test_each_check_catches_its_defect(spark):
    t = ntz("2024-01-01 00:00:00")
    rows = [(1, "d", 1.0, 1.0, t, t, "ok"), (1, "d", 1.0, 1.0, t, t, "ok"),       # duplicate event_id
            (None, None, 1.0, 1.0, None, t, "weird"), (3, "e", 1.0, 1.0, t, t, "odd")]
    s = spark.createDataFrame(rows, SILVER)
    gold = spark.createDataFrame([("d", dt.date(2024, 1, 1), 1), ("d", dt.date(2024, 1, 1), None)],
                                 "device_id string, event_date date, event_count bigint")
    res = results(Q.run_checks({"iot_validated": s, "device_daily": gold}))
    assert res[("unique", "iot_validated", "event_id")] == 1
    assert res[("not_null", "iot_validated", "event_id")] == 1
    assert res[("not_null", "iot_validated", "device_id")] == 1
    assert res[("not_null", "iot_validated", "event_ts")] == 1
    assert res[("accepted_values", "iot_validated", "severity")] == 2
    assert res[("not_null", "device_daily", "event_count")] == 1
    assert res[("unique_combination", "device_daily", "device_id,event_date")] == 1
    assert Q.failing(Q.run_checks({"iot_validated": s, "device_daily": gold})).count() == 7


def test_checks_counted_while_writing_equal_a_scan(spark, workdir):
    """Over a bronze whose silver has null and repeated ids; an odd severity can only come from outside the build."""
    from geofleet.operators import quality as Q
    from geofleet.plans.medallion_build import build_medallion
    from geofleet.sources.fixtures import broken_tables, source_events
    from tests.conftest import SF_SMALL

    bad = source_events(spark, SF_SMALL).selectExpr("IF(id % 5 = 0, NULL, id - id % 2) AS id", "device_id", "latitude", "longitude", "event_ts", "ingested_at")
    bad.write.parquet(f"{workdir}/bronze")
    metrics: dict = {}
    names = build_medallion(spark, f"{workdir}/bronze", f"{workdir}/wh", {k: f"observed_{k}" for k in ("staging", "silver", "gold")}, metrics)
    tables = {"iot_validated": spark.table(names["silver"]), "device_daily": spark.table(names["gold"])}
    got, want = (sorted(map(tuple, df.collect())) for df in (Q.checks_after_write(spark, tables, metrics), Q.run_checks(tables)))
    assert got == want and sum(r[3] > 0 for r in got) == 2
    # values outside the list are found by the write, and how many by a scan
    odd = broken_tables(spark, SF_SMALL)
    written = {}
    for model, df in odd.items():
        observed, written[model] = Q.observed(df, model)
        observed.write.parquet(f"{workdir}/{model}")
    assert sorted(map(tuple, Q.checks_after_write(spark, odd, written).collect())) == sorted(map(tuple, Q.run_checks(odd).collect()))


def test_counts_come_from_footers(spark, workdir):
    from geofleet.sources.files import stored_counts

    spark.range(1000).selectExpr("id", "id % 3 AS day").write.partitionBy("day").parquet(f"{workdir}/a")
    spark.range(7).write.parquet(f"{workdir}/b")
    counts = stored_counts(spark, {"a": f"{workdir}/a", "b": f"{workdir}/b"})
    assert counts._jdf.queryExecution().executedPlan().toString().count("PushedAggregation: [COUNT(*)]") == 2
    assert sorted(map(tuple, counts.collect())) == [("a", 1000), ("b", 7)]

"""Structured Streaming jobs: stream = batch, archive layout, serving stream."""

from __future__ import annotations

import datetime as dt
import glob
import json
import os

from pyspark.sql import functions as F

from geofleet import constants as K
from geofleet.operators import archive as A
from geofleet.operators.ingest import decode_envelope
from geofleet.operators import serving as S
from geofleet.plans.catalog import accepted, archive_records, cdc_messages, silver
from geofleet.operators import ingest as I
from geofleet.plans.serving_job import ServingStore
from geofleet.sources.cdc import unwrap_cdc
from geofleet.sources.fixtures import damaged_cdc_messages, events_to_messages, events_to_source, source_to_cdc
from geofleet.sources.tables import stream_table
from geofleet.sources.topics import publish, read_topic
from geofleet.streaming import jobs as J
from tests.conftest import SF_SMALL


def _same(a, b):
    cols = sorted(a.columns)
    return sorted(map(tuple, a.select(cols).collect()), key=repr) == sorted(map(tuple, b.select(cols).collect()), key=repr)


def events(spark):
    return stream_table(spark, SF_SMALL, "events")


def enveloped(spark):
    messages = I.route_topic(events_to_messages(events(spark)))
    return I.envelope(I.accepted_readings(I.normalise_readings(messages)))


def test_silver_stream_equals_batch(spark, workdir):
    J.silver_stream(events_to_source(events(spark)), f"{workdir}/out", f"{workdir}/ck").awaitTermination()
    assert _same(spark.read.parquet(f"{workdir}/out"), silver(spark, SF_SMALL))
    # restart on the same checkpoint: nothing new, nothing duplicated
    J.silver_stream(events_to_source(events(spark)), f"{workdir}/out", f"{workdir}/ck").awaitTermination()
    assert spark.read.parquet(f"{workdir}/out").count() == silver(spark, SF_SMALL).count()


def test_bronze_stream_equals_batch(spark, workdir):
    feed = source_to_cdc(events_to_source(events(spark)))
    J.bronze_stream(feed, f"{workdir}/out", f"{workdir}/rejects", f"{workdir}/ck").awaitTermination()
    assert _same(spark.read.parquet(f"{workdir}/out").drop("batch_id"), unwrap_cdc(cdc_messages(spark, SF_SMALL)))
    assert spark.read.parquet(f"{workdir}/rejects").count() == 0


def test_archive_stream_layout(spark, workdir):
    J.archive_stream(enveloped(spark), f"{workdir}/arch", f"{workdir}/ck", K.ARCHIVE_RECORDS_PER_FILE, clock="event").awaitTermination()
    files = [f for f in glob.glob(f"{workdir}/arch/year=*/month=*/day=*/hour=*/*.txt")]
    assert files
    for f in files:
        lines = open(f).read().splitlines()
        assert 0 < len(lines) <= K.ARCHIVE_RECORDS_PER_FILE
        env = json.loads(lines[0])
        assert set(env) == {"schema", "payload"} and env["schema"]["name"] == "iot.GeoLocation"
    hour_dirs = {os.path.basename(os.path.dirname(f)) for f in files}
    assert all(len(d) == len("hour=07") for d in hour_dirs)
    # restoring reads payload.* and gives back exactly the accepted readings
    restored = decode_envelope(A.read_archive(spark, f"{workdir}/arch"))
    want = accepted(spark, SF_SMALL).drop("msg_id")
    assert _same(restored, want)


def test_archive_retention_rewrite(spark, workdir):
    rec = archive_records(spark, SF_SMALL)
    A.write_archive(rec, f"{workdir}/arch", K.ARCHIVE_RECORDS_PER_FILE)
    files = glob.glob(f"{workdir}/arch/year=*/month=*/day=*/hour=*/*.txt")
    assert all(sum(1 for _ in open(f)) <= K.ARCHIVE_RECORDS_PER_FILE for f in files)
    as_of = dt.datetime(2024, 1, 30)
    per_hour = A.archive_objects(spark, f"{workdir}/arch").collect()
    untouched = {f: os.stat(f).st_mtime_ns for f in files if f > f"{workdir}/arch/year=2024/month=01/day=16"}
    assert A.expire_archive(spark, f"{workdir}/arch", as_of) == len({os.path.dirname(f) for f in files} - {os.path.dirname(f) for f in untouched})
    assert A.expire_archive(spark, f"{workdir}/arch", as_of) == 0
    assert {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{workdir}/arch/year=*/month=*/day=*/hour=*/*.txt")} == untouched
    kept = A.read_archive(spark, f"{workdir}/arch")
    hours = {(r.year, r.month, r.day, r.hour) for r in kept.select(*A.PARTITION_COLUMNS).distinct().collect()}
    cutoff = ("2024", "01", "16", "00")
    assert hours and min(hours) >= cutoff and all(len(h[3]) == 2 for h in hours)
    want = rec.where(F.col("timestamp") >= S.epoch_ms(dt.datetime(2024, 1, 16)))
    assert kept.count() == want.count()
    assert sum(r.object_count for r in per_hour) == len(files)
    assert all(r.object_count * K.ARCHIVE_RECORDS_PER_FILE >= r.record_count for r in per_hour)
    assert sum(r.record_count for r in per_hour) == rec.count()


def test_archive_by_arrival(spark, workdir):
    before = dt.datetime.now(dt.timezone.utc).replace(minute=0, second=0, microsecond=0, tzinfo=None)
    J.archive_stream(enveloped(spark), f"{workdir}/arch", f"{workdir}/ck", 1_000_000).awaitTermination()
    hours = A.read_archive(spark, f"{workdir}/arch").groupBy(A.hour_start(*[F.col(c) for c in A.PARTITION_COLUMNS]).alias("h")).count().collect()
    assert sum(r["count"] for r in hours) == accepted(spark, SF_SMALL).count()
    assert all(before <= r.h <= dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) for r in hours)


def test_serving_stream(spark, workdir):
    silver(spark, SF_SMALL).write.parquet(f"{workdir}/silver")
    store = ServingStore(spark, f"{workdir}/store")
    J.serving_stream(J.table_stream(spark, f"{workdir}/silver"), store, f"{workdir}/ck").awaitTermination()
    want = S.latest_per_key(S.serving_rows(silver(spark, SF_SMALL)))
    assert _same(store.table().drop("batch_id"), want)
    # a second stream starts its epochs at 0 again: its rows are new versions, none is lost
    moved = silver(spark, SF_SMALL).where("event_id < 50").withColumn("latitude", F.lit(1.5))
    moved.write.parquet(f"{workdir}/moved")
    J.serving_stream(J.table_stream(spark, f"{workdir}/moved"), store, f"{workdir}/ck2").awaitTermination()
    assert store.table().where("latitude = 1.5").count() == moved.count()


def test_ingest_stream(spark, workdir):
    J.ingest_stream(events_to_messages(events(spark)), f"{workdir}/table", f"{workdir}/rejects", f"{workdir}/ck").awaitTermination()
    rows = spark.read.parquet(f"{workdir}/table")
    rejects = spark.read.parquet(f"{workdir}/rejects")
    assert rows.count() > 0 and rejects.count() > 0
    assert rows.select("id").distinct().count() == rows.count()


def test_topic_publish_and_table_sink(spark, workdir):
    """Readings -> envelope -> 'iot-events' (a topic folder, two publishes) -> table rows."""
    env = I.envelope(accepted(spark, SF_SMALL)).withColumn("timestamp", F.timestamp_millis("timestamp"))
    for part in ("msg_id % 2 = 0", "msg_id % 2 = 1"):
        assert publish(env.where(part), K.EVENTS_TOPIC, folder=f"{workdir}/topics") == 1
    topic = read_topic(spark, K.EVENTS_TOPIC, folder=f"{workdir}/topics")
    J.table_sink_stream(topic, f"{workdir}/table", f"{workdir}/ck").awaitTermination()
    rows = spark.read.parquet(f"{workdir}/table")
    want = I.sink_rows(I.decode_envelope(I.envelope(accepted(spark, SF_SMALL))), ingested_at=dt.datetime(2024, 1, 30))
    cols = ["id", "device_id", "latitude", "longitude", "event_ts"]
    assert _same(rows.select(cols), want.select(cols))


def test_publish_keeps_each_keys_order_and_slices_hot_keys(spark):
    records = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 40)).alias("key"),
                                       F.lit("{}").alias("value"), F.current_timestamp().alias("timestamp"), F.col("id").alias("msg_id"))
    written = []

    def write(part):
        rows = part.withColumn("task", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).collect()
        written.append(sorted(rows, key=lambda r: r["at"]))

    assert publish(records.repartition(6), "t", slice_rows=500, write=write) == len(written) >= 6
    seen = {}
    for slice_ in written:
        tasks = {}
        for r in slice_:
            tasks.setdefault(r.key, set()).add(r.task)
            seen.setdefault(r.key, []).append(r.msg_id)
        assert all(len(t) == 1 for t in tasks.values())
        assert sum(r.key == "hot" for r in slice_) < 1000
    assert all(ids == sorted(ids) for ids in seen.values()) and sum(map(len, seen.values())) == 5000


def test_bronze_from_cdc_topic(spark, workdir):
    feed = damaged_cdc_messages(spark, SF_SMALL).select("key", "value", F.col("position").alias("msg_id"),
                                                        F.timestamp_millis("position").alias("timestamp"))
    publish(feed, K.CDC_TOPIC, folder=f"{workdir}/topics")
    topic = read_topic(spark, K.CDC_TOPIC, folder=f"{workdir}/topics")
    J.bronze_stream(topic, f"{workdir}/bronze", f"{workdir}/rejects", f"{workdir}/ck").awaitTermination()
    bronze, rejects = (spark.read.parquet(f"{workdir}/{x}").drop("batch_id") for x in ("bronze", "rejects"))
    assert _same(bronze, unwrap_cdc(damaged_cdc_messages(spark, SF_SMALL)))
    assert {r.reject_reason for r in rejects.collect()} == {"malformed", "event_ts"}
    assert bronze.count() + rejects.count() == feed.count()
    # silver reads what bronze wrote
    J.silver_stream(J.table_stream(spark, f"{workdir}/bronze"), f"{workdir}/silver", f"{workdir}/ck2").awaitTermination()
    assert spark.read.parquet(f"{workdir}/silver").count() == bronze.where("device_id is not null and event_ts is not null").count()

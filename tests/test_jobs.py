"""The scheduled-job entry points, driven in-process."""

from __future__ import annotations

import importlib.util
import os

from geofleet.plans.serving_job import ServingStore
from geofleet.sources.fixtures import source_events
from tests.conftest import SF_SMALL

_spec = importlib.util.spec_from_file_location(
    "geofleet_jobs", os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts", "jobs.py"))
jobs = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(jobs)


def test_medallion_quality_serve(spark, workdir):
    source_events(spark, SF_SMALL).write.parquet(f"{workdir}/bronze")
    assert jobs.main(["medallion", "--bronze", f"{workdir}/bronze", "--root", f"{workdir}/wh"], spark) == 0
    assert jobs.main(["quality"], spark) == 0
    # a second build switches over; the bronze folder is read where it lies
    assert jobs.main(["medallion", "--bronze", f"{workdir}/bronze", "--root", f"{workdir}/wh"], spark) == 0
    assert not os.path.exists(f"{workdir}/wh/raw/iot_events")
    silver_path = f"{workdir}/silver"
    spark.table("clean.iot_validated").write.parquet(silver_path)
    args = ["serve", "--silver", silver_path, "--store", f"{workdir}/store", "--as-of", "2024-01-30T00:00:00"]
    assert jobs.main(args + ["--batch-id", "1"], spark) == 0
    assert jobs.main(args + ["--batch-id", "1"], spark) == 0          # repeated: no-op
    assert ServingStore(spark, f"{workdir}/store").table().count() > 0


def test_quality_reports_failure(spark, workdir):
    from pyspark.sql import functions as F

    bad = source_events(spark, SF_SMALL).withColumn("id", F.lit(1).cast("bigint"))   # every id duplicated
    bad.write.parquet(f"{workdir}/bronze")
    jobs.main(["medallion", "--bronze", f"{workdir}/bronze", "--root", f"{workdir}/wh"], spark)
    assert jobs.main(["quality"], spark) == 1


def test_expire_deletes_old_hours_only(spark, workdir):
    from pyspark.sql import functions as F

    from geofleet.operators import archive as A
    from geofleet.plans.catalog import AS_OF, archive_records

    A.write_archive(archive_records(spark, SF_SMALL).drop("key"), f"{workdir}/arch", 1_000)
    hour = A.hour_start(F.col("year"), F.col("month"), F.col("day"), F.col("hour"))
    cutoff = F.lit(AS_OF.replace(day=16)).cast("timestamp_ntz")
    want = sorted(map(tuple, A.archive_objects(spark, f"{workdir}/arch").where(hour >= cutoff).collect()))
    assert jobs.main(["expire", "--archive", f"{workdir}/arch", "--as-of", AS_OF.isoformat()], spark) == 0
    assert want and sorted(map(tuple, A.archive_objects(spark, f"{workdir}/arch").collect())) == want


def test_stream_commands_over_topic_folders(spark, workdir):
    from pyspark.sql import functions as F

    from geofleet import constants as K
    from geofleet.operators import ingest as I
    from geofleet.plans.catalog import accepted, cdc_messages
    from geofleet.sources.fixtures import device_messages
    from geofleet.sources.topics import publish

    topics = f"{workdir}/topics"
    at = F.timestamp_millis(F.col("msg_id"))
    publish(device_messages(spark, SF_SMALL).select(F.col("topic").alias("key"), F.col("payload").alias("value"), "msg_id", at.alias("timestamp")), "raw", folder=topics)
    publish(I.envelope(accepted(spark, SF_SMALL)).withColumn("timestamp", at), K.EVENTS_TOPIC, folder=topics)
    publish(cdc_messages(spark, SF_SMALL).withColumnRenamed("position", "msg_id").withColumn("timestamp", at), K.CDC_TOPIC, folder=topics)

    def run(command, *args, topic=None):
        edge = ["--topic", topic, "--folder", topics] if topic else []
        return jobs.main([command, *edge, *args, "--checkpoint", f"{workdir}/ck-{command}", "--once"], spark)

    assert run("ingest", "--out", f"{workdir}/table", "--rejects", f"{workdir}/bad", topic="raw") == 0
    assert run("append", "--out", f"{workdir}/sink", topic=K.EVENTS_TOPIC) == 0
    assert run("bronze", "--out", f"{workdir}/bronze", "--rejects", f"{workdir}/bad2", topic=K.CDC_TOPIC) == 0
    assert run("silver", "--bronze", f"{workdir}/bronze", "--out", f"{workdir}/silver") == 0
    assert run("archive", "--out", f"{workdir}/arch", "--records-per-file", "500", topic=K.EVENTS_TOPIC) == 0
    assert run("serving", "--silver", f"{workdir}/silver", "--store", f"{workdir}/store") == 0
    assert run("current", "--out", f"{workdir}/current", topic=K.CDC_TOPIC) == 0
    for command in ("distinct", "daily", "hourly"):
        assert run(command, "--silver", f"{workdir}/silver", "--out", f"{workdir}/{command}", "--delay", "1 hour") == 0
    assert run("latest", "--silver", f"{workdir}/silver", "--out", f"{workdir}/latest") == 0
    assert spark.read.parquet(f"{workdir}/distinct").count() > spark.read.parquet(f"{workdir}/daily").count() > 0
    n = accepted(spark, SF_SMALL).count()
    assert spark.read.parquet(f"{workdir}/table").count() == spark.read.parquet(f"{workdir}/sink").count() == n
    assert spark.read.text(f"{workdir}/arch").count() == n
    assert ServingStore(spark, f"{workdir}/store").table().count() > 0

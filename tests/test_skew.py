"""Hot keys: one device (or hour) holding most rows must still be cut into many tasks."""

from __future__ import annotations

import datetime as dt

import pytest

from pyspark.sql import functions as F

from geofleet.operators import archive as A
from geofleet.operators.serving import serving_rows
from geofleet.plans.medallion_build import build_medallion
from geofleet.plans.serving_job import ServingStore

N = 20_000


def hot_bronze(spark):
    """Two thirds of the rows belong to one device, the rest to 50 others; one day of data."""
    t0 = dt.datetime(2024, 1, 1)
    return spark.range(N).select(
        F.col("id"),
        F.when(F.col("id") % 3 != 0, F.lit("device-hot")).otherwise(
            F.format_string("device-%03d", F.col("id") % 50)).alias("device_id"),
        F.lit(51.5).alias("latitude"), F.lit(0.1).alias("longitude"),
        F.timestamp_add("SECOND", F.col("id"), F.lit(t0).cast("timestamp_ntz")).alias("event_ts"),
        F.timestamp_add("SECOND", F.col("id") + 5, F.lit(t0).cast("timestamp_ntz")).alias("ingested_at"),
    )


def files_holding(df, predicate) -> int:
    return df.where(predicate).select(F.input_file_name()).distinct().count()


def test_hot_device_split_across_files(spark, workdir):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot_bronze(spark).write.parquet(f"{workdir}/bronze")
        names = build_medallion(spark, f"{workdir}/bronze", f"{workdir}/wh")
        silver = spark.table(names["silver"])
        assert files_holding(silver, F.col("device_id") == "device-hot") > 1

        store = ServingStore(spark, f"{workdir}/store")
        store.write_batch(serving_rows(silver), 1)
        store.commit(1, dt.datetime(2024, 1, 1))
        assert files_holding(store.rows(), F.col("device_id") == "device-hot") > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_hour_split_across_tasks(spark, workdir):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t0 = dt.datetime(2024, 1, 1, 7)
        rec = spark.range(N).select(
            F.col("id").alias("msg_id"), F.lit("{}").alias("value"),
            # all but a few records fall into 07:00
            F.when(F.col("id") % 100 == 0, F.lit(dt.datetime(2024, 1, 1, 9)).cast("timestamp_ntz"))
            .otherwise(F.lit(t0).cast("timestamp_ntz")).alias("clock"),
        )
        A.write_archive(A.with_archive_partition(rec, F.col("clock")).drop("clock"), f"{workdir}/arch",
                        records_per_file=N)     # no per-file cap: files == writing tasks
        hot = A.archive_objects(spark, f"{workdir}/arch").where("hour = '07'").first()
        assert hot.record_count == N - N // 100 and hot.object_count > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_device_keyed_publish_split_across_tasks(spark):
    """A device holding two thirds of the records keeps one topic partition, in arrival
    order, yet its records are numbered by many tasks; columns beside the numbering's change nothing."""
    from geofleet.operators.ingest import keyed_publish

    rec = hot_bronze(spark).select(
        F.col("id").alias("msg_id"), F.col("device_id").alias("key"), F.lit("{}").alias("value"), F.rand(3).alias("extra"))
    published = keyed_publish(rec, partitions=3)
    rows = published.collect()
    assert len(rows) == N and len({(r.partition, r.offset) for r in rows}) == N
    for p in {r.partition for r in rows}:
        own = sorted((r.offset, r.msg_id) for r in rows if r.partition == p)
        assert [o for o, _ in own] == list(range(len(own))) and [m for _, m in own] == sorted(m for _, m in own)
    assert len({r.partition for r in rows if r.key == "device-hot"}) == 1


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_ordinal_is_dense_with_columns_outside_the_order(spark, adaptive):
    from geofleet.operators.ranking import ordinal

    n = 400_000
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        df = spark.range(n).select(F.col("id"), F.xxhash64("id").alias("key"), F.concat(F.lit("x"), F.col("id")).alias("extra"))
        out = ordinal(df, ["key"], "id").cache()
        got = out.agg(F.count("*").alias("n"), F.countDistinct("position").alias("d"), F.min("position").alias("lo"), F.max("position").alias("hi"),
                      F.count_if(F.col("extra") != F.concat(F.lit("x"), F.col("id"))).alias("bad")).first()
        assert (got.n, got.d, got.lo, got.hi, got.bad) == (n, n, 0, n - 1, 0)
        assert [r.key for r in out.orderBy("position").limit(50).collect()] == [r.key for r in df.orderBy("key").limit(50).collect()]
        out.unpersist()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scale_settings(spark, workdir):
    from geofleet.session import input_bytes, scale_settings

    big = scale_settings(100 * 2**40, total_cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**12     # no cap: 256 MB each
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    small = scale_settings(10 * 2**20, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    spark.range(1000).write.parquet(f"{workdir}/x")
    assert input_bytes(spark, f"{workdir}/x") > 1000


def test_scratch_must_be_shared_off_one_machine(spark):
    from types import SimpleNamespace as Object

    from geofleet import session

    def named(**conf):
        return Object(conf=Object(get=lambda key, default=None: conf.get(key.replace(".", "_"), default)),
                      sparkContext=Object(getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None))

    assert session.is_local(spark) and not session.is_local(named(spark_master="local-cluster[2,1,1024]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(named(spark_master="yarn"))
    assert session.checkpoint_root(named(spark_master="yarn", spark_checkpoint_dir="hdfs://x/y/")) == "hdfs://x/y"

"""The archive in small objects: each record made once, objects written and counted by the tasks."""

from __future__ import annotations

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from geofleet.operators import archive as A

COUNTED = [*A.PARTITION_COLUMNS, "object_count", "record_count", "largest_object"]


def read_by_spark(spark, path):
    """Objects counted through Spark's own text reader."""
    files = A.read_archive(spark, path).groupBy(*A.PARTITION_COLUMNS, F.col("_metadata.file_path").alias("f")).count()
    return files.groupBy(*A.PARTITION_COLUMNS).agg(F.count("f").alias("object_count"), F.sum("count").alias("record_count"), F.max("count").alias("largest_object"))


def rows(df):
    return sorted(map(str, df.select(*COUNTED).collect()))


def test_records_are_made_once_and_objects_need_no_program_each(spark, workdir):
    made = spark.sparkContext.accumulator(0)

    def value(i):
        made.add(1)
        return f'{{"n":{i},"t":"é "}}'

    n = 3000
    clock = F.timestamp_add("MINUTE", (F.col("id") % 600).cast("int"), F.lit(dt.datetime(2024, 1, 1, 7)).cast("timestamp_ntz"))
    records = A.with_archive_partition(spark.range(n).select(F.col("id").alias("msg_id"), F.udf(value, "string")("id").alias("value"), clock.alias("clock")), F.col("clock"))
    A.write_archive(records, f"{workdir}/arch", 10)
    assert made.value == n                                                     # sampling and writing made each record before
    files = glob.glob(f"{workdir}/arch/*/*/*/*/*.txt")
    assert len(files) >= n / 10 and not glob.glob(f"{workdir}/arch/*/*/*/*/.*")  # no checksum or unfinished file beside an object
    got = A.read_archive(spark, f"{workdir}/arch")
    assert {r.value for r in got.collect()} == {value(i) for i in range(n)} and got.count() == n
    assert rows(A.archive_objects(spark, f"{workdir}/arch")) == rows(read_by_spark(spark, f"{workdir}/arch"))
    assert A.archive_objects(spark, f"{workdir}/arch").agg(F.max("largest_object")).first()[0] == 10


def test_large_objects_make_records_once_too(spark, workdir):
    made = spark.sparkContext.accumulator(0)

    def value(i):
        made.add(1)
        return f'{{"n":{i}}}'

    n = 3000
    hour = F.format_string("%02d", F.col("id") % 24)
    records = spark.range(n).select(F.col("id").alias("msg_id"), F.udf(value, "string")("id").alias("value"), *[F.lit("01").alias(c) for c in A.PARTITION_COLUMNS[:3]], hour.alias("hour"))
    A.write_archive(records, f"{workdir}/arch", 100_000)
    assert made.value == n                                                     # twice before
    assert A.read_archive(spark, f"{workdir}/arch").select("value").distinct().count() == n


def test_small_objects_hold_odd_rows_as_large_ones_do(spark, workdir):
    odd = [(1, "a", "2024", "01", "02", "03"), (1, "a", "2024", "01", "02", "03"), (None, None, None, None, None, None), (2, "", "2024", "01", "02", "03"),
           (3, "b", None, "01", "02", "03"), (4, "c", "+10000", "01", "02", "a=b/%"), (5, "c\rd", "2024", "01", "02", "04")]
    schema = "msg_id LONG, value STRING, " + ", ".join(f"{c} STRING" for c in A.PARTITION_COLUMNS)
    df = spark.createDataFrame(odd, schema)
    for path, limit in (("small", 2), ("large", 100_000)):
        A.write_archive(df, f"{workdir}/{path}", limit)
        A.write_archive(df.where("msg_id = 1"), f"{workdir}/{path}", limit)     # appended
    archives = [A.read_archive(spark, f"{workdir}/{path}") for path in ("small", "large")]
    assert sorted(map(str, archives[0].collect())) == sorted(map(str, archives[1].collect()))
    assert archives[0].count() == 10                                           # the text reader ends a line at a bare \r too
    for path in ("small", "large"):
        assert rows(A.archive_objects(spark, f"{workdir}/{path}")) == rows(read_by_spark(spark, f"{workdir}/{path}"))


def test_an_empty_archive(spark, workdir):
    df = spark.createDataFrame([], "msg_id LONG, value STRING, " + ", ".join(f"{c} STRING" for c in A.PARTITION_COLUMNS))
    A.write_archive(df, f"{workdir}/arch", 10)
    assert A.archive_objects(spark, f"{workdir}/arch").count() == 0


def test_other_stores_go_through_spark(spark, workdir):
    from geofleet.sources.files import mounted_path

    assert mounted_path(spark, f"file:{workdir}/x") == f"{workdir}/x" == mounted_path(spark, f"{workdir}/x")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.store.link./in", f"file://{workdir}")
    assert mounted_path(spark, "viewfs://store/in/x") is None
    df = spark.range(25).select(F.col("id").alias("msg_id"), F.lit("{}").alias("value"), *[F.lit("01").alias(c) for c in A.PARTITION_COLUMNS])
    A.write_archive(df, "viewfs://store/in/far", 10)
    far, near = A.archive_objects(spark, "viewfs://store/in/far"), A.archive_objects(spark, f"{workdir}/far")
    assert rows(far) == rows(near) and far.first().record_count == 25 and os.path.isdir(f"{workdir}/far")

"""Hourly JSON archive of the event topic.

Objects are laid out ``year=YYYY/month=MM/day=dd/hour=HH`` in UTC and expire
after fourteen days. The partition clock is the record's arrival time by
default; event time is an option. How many records an object holds at most
is always the caller's choice: ``K.ARCHIVE_RECORDS_PER_FILE`` is the layout
being reproduced, and far too small for large runs.
"""

from __future__ import annotations

import datetime as dt
import glob
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geofleet import constants as K
from geofleet.functions.time import ntz_literal
from geofleet.session import scratch_path
from geofleet.sources.files import delete_folders, mounted_path

PARTITION_COLUMNS = ["year", "month", "day", "hour"]
# Objects of fewer records cost more to open than to fill.
SMALL_OBJECT_RECORDS = 1000
# Folder name of a partition value that is null or empty.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def with_archive_partition(records: DataFrame, clock: Column) -> DataFrame:
    """Add zero-padded text partition columns from an NTZ clock column."""
    return records.select(
        "*",
        F.date_format(clock, "yyyy").alias("year"), F.date_format(clock, "MM").alias("month"),
        F.date_format(clock, "dd").alias("day"), F.date_format(clock, "HH").alias("hour"),
    )


def hourly_counts(partitioned: DataFrame) -> DataFrame:
    return partitioned.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("record_count"))


# Partition values are read back as text so 'hour=07' stays '07'.
ARCHIVE_READ_SCHEMA = "value STRING, year STRING, month STRING, day STRING, hour STRING"


def write_archive(partitioned: DataFrame, path: str, records_per_file: int, mode: str = "append") -> None:
    """Write each record's envelope as one JSON line under its hour folder,
    ``records_per_file`` lines per object at most.

    Records are range-partitioned on (hour, msg_id) before the write: each
    task writes one or a few hour folders, and an hour holding a third of all
    records is cut into as many evenly sized tasks as its volume needs. They
    are stored before that: range partitioning reads its input twice, to
    sample and to deal it, and records are costly to make.
    """
    spark = partitioned.sparkSession
    columns = ["msg_id", "value", *PARTITION_COLUMNS]
    stored = scratch_path(spark, "records")
    try:
        partitioned.select(columns).write.parquet(stored)
        records = spark.read.schema(partitioned.select(columns).schema).parquet(stored)
        root = mounted_path(spark, path) if mode == "append" and records_per_file < SMALL_OBJECT_RECORDS else None
        if root is not None:
            _write_objects(records, root, records_per_file)
            return
        (
            records.repartitionByRange(*PARTITION_COLUMNS, "msg_id").select("value", *PARTITION_COLUMNS).write.mode(mode)
            .option("maxRecordsPerFile", records_per_file)
            .partitionBy(*PARTITION_COLUMNS)
            .text(path)
        )
    finally:
        delete_folders(spark, [stored])


def _tasks(spark: SparkSession) -> int:
    """Tasks for work that is counted in objects; adaptive execution would join tasks of few bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def _write_objects(records: DataFrame, root: str, records_per_file: int) -> None:
    """Small objects on a mounted file system, written by the tasks themselves: there Hadoop starts a program to set the
    permissions of every object and of its checksum, which costs more than all else.

    A task's records are in a fixed order and its objects have fixed names, each put in place whole, so an attempt
    that is repeated puts the same objects in the same places.
    """
    spark, run, columns = records.sparkSession, uuid.uuid4().hex[:12], list(PARTITION_COLUMNS)

    def write(batches):
        import os
        import re

        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get()
        hour, lines, objects, made = None, [], 0, set()

        def put() -> None:
            names = [re.sub(r"[\x01-\x1f\"#%'*/:=?\\\x7f{\[\]^]", lambda m: f"%{ord(m[0]):02X}", v) if v else NO_VALUE for v in hour]
            folder = "/".join([root.rstrip("/"), *[f"{c}={v}" for c, v in zip(columns, names)]])
            if folder not in made:
                os.makedirs(folder, exist_ok=True)
                made.add(folder)
            name = f"part-{task.partitionId():05d}-{run}-c{objects:06d}.txt"
            hidden = f"{folder}/.{name}.{task.taskAttemptId()}"
            with open(hidden, "wb") as out:
                out.write("".join(x + "\n" for x in lines).encode())
            os.replace(hidden, f"{folder}/{name}")

        for batch in batches:
            for value, *own in zip(*[batch.column(c).to_pylist() for c in ["value", *columns]]):
                if lines and (own != hour or len(lines) == records_per_file):
                    put()
                    lines, objects = [], objects + 1
                hour = own
                lines.append(value or "")
        if lines:
            put()
            objects += 1
        yield pa.RecordBatch.from_pydict({"objects": pa.array([objects], pa.int64())})

    os.makedirs(root, exist_ok=True)
    dealt = records.repartitionByRange(_tasks(spark), *PARTITION_COLUMNS, "msg_id").sortWithinPartitions(*PARTITION_COLUMNS, "msg_id", "value")
    dealt.select("value", *PARTITION_COLUMNS).mapInArrow(write, "objects LONG").agg(F.sum("objects")).collect()


def read_archive(spark, path: str) -> DataFrame:
    """Archived envelope lines with their (text) hour partition values."""
    return spark.read.schema(ARCHIVE_READ_SCHEMA).text(path)


def archive_objects(spark, path: str) -> DataFrame:
    """Objects, records and the largest object's records per hour folder of a written archive (no driver-side listing of objects).

    Counted from the file metadata column by Spark; on a mounted file system tasks list the hour folders and read the
    objects themselves, as the reader's listing keeps every object on the driver and opens each at a high cost.
    """
    root = mounted_path(spark, path)
    if root is None:
        lines = read_archive(spark, path).groupBy(*PARTITION_COLUMNS, F.col("_metadata.file_path").alias("_file")).agg(
            F.count(F.lit(1)).alias("_n"))
    else:
        lines = _object_lines(spark, root)
    return lines.groupBy(*PARTITION_COLUMNS).agg(
        F.count(F.lit(1)).alias("object_count"), F.sum("_n").alias("record_count"), F.max("_n").alias("largest_object"))


def _object_lines(spark: SparkSession, root: str) -> DataFrame:
    """(year, month, day, hour, _n): the lines of each object that holds any."""
    columns = list(PARTITION_COLUMNS)

    def listed(batches):
        import itertools
        import os

        import pyarrow as pa

        for batch in batches:
            for folder in batch.column(0).to_pylist():
                with os.scandir(folder) as found:
                    names = (x.name for x in found if x.is_file() and not x.name.startswith((".", "_")))
                    while part := list(itertools.islice(names, 10_000)):
                        yield pa.RecordBatch.from_pydict({"folder": pa.array([folder] * len(part), pa.string()), "name": pa.array(part, pa.string())})

    def counted(batches):
        from urllib.parse import unquote

        import pyarrow as pa

        for batch in batches:
            folders, n = batch.column("folder").to_pylist(), []
            for folder, name in zip(folders, batch.column("name").to_pylist()):
                with open(f"{folder}/{name}", encoding="latin-1", newline=None) as lines:
                    n.append(sum(1 for _ in lines))
            values = [[unquote(x.partition("=")[2]) for x in f.split("/")[-len(columns):]] for f in folders]
            out = {c: pa.array([None if v[i] == NO_VALUE else v[i] for v in values], pa.string()) for i, c in enumerate(columns)}
            yield pa.RecordBatch.from_pydict(out | {"_n": pa.array(n, pa.int64())})

    # One name per hour reaches the driver.
    pattern = "/".join([glob.escape(root.rstrip("/")), *[f"{c}=*" for c in columns]])
    folders = spark.createDataFrame([(x,) for x in glob.glob(pattern)], "folder STRING").repartition(_tasks(spark))
    objects = folders.mapInArrow(listed, "folder STRING, name STRING").repartition(_tasks(spark))
    return objects.mapInArrow(counted, ", ".join(f"{c} STRING" for c in columns) + ", _n LONG").where("_n > 0")


def hour_start(year: Column, month: Column, day: Column, hour: Column) -> Column:
    return F.to_timestamp_ntz(F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit(" "), hour, F.lit(":00:00")))


def expire_archive(spark, path: str, as_of: dt.datetime, days: int = K.ARCHIVE_RETENTION_DAYS) -> int:
    """Delete the hour folders that ended ``days`` or more before ``as_of``; how many there were.

    The folders are taken from the file listing; no content is read, and what is kept isn't rewritten.
    """
    ended = hour_start(*[F.col(c) for c in PARTITION_COLUMNS]) + F.expr("INTERVAL 1 HOUR")
    files = spark.read.format("binaryFile").schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY, "
                                                   + ", ".join(f"{c} STRING" for c in PARTITION_COLUMNS)).load(path)
    expired = files.where(ended <= ntz_literal(as_of - dt.timedelta(days=days))).select(*PARTITION_COLUMNS).distinct()
    folders = ["/".join(f"{c}={r[c]}" for c in PARTITION_COLUMNS) for r in expired.toLocalIterator()]
    return delete_folders(spark, [f"{path.rstrip('/')}/{x}" for x in folders])

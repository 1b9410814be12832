"""Incremental load of the keyed serving table.

Under ``root``: ``table`` holds the newest version of every key, partitioned by event_date and bucketed by device_id;
``progress`` one row per committed load, whose newest is the mark; ``pending`` the load that is under way.

A load merges its rows with those of the days that they touch and writes these days to ``pending``; its progress row commits
it; then the days replace the table's (dynamic partition overwrite) and ``pending`` goes. A load that dies before
its progress row is made anew in its place. One that dies after it is finished from ``pending`` by the next writer; until
then readers may find some of its days old. Batch ids only grow.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geofleet.functions.time import epoch_millis_to_ntz, ntz_literal
from geofleet.operators.serving import (
    COORD_DECIMAL,
    SERVING_COLUMNS,
    after_mark,
    device_series,
    first_run_watermark,
    latest_per_key,
    recent_scan,
    serving_rows,
)
from geofleet.session import checkpoint_root
from geofleet.sources.files import delete_folders, folder_exists, read_or_empty

VERSION_SCHEMA = (f"device_id STRING, event_time BIGINT, latitude {COORD_DECIMAL}, longitude {COORD_DECIMAL}, "
                  "event_ts STRING, event_id BIGINT, batch_id BIGINT, event_date DATE")
PROGRESS_SCHEMA = "last_event_ts TIMESTAMP_NTZ, rows_written BIGINT, source STRING, batch_id BIGINT"
BUCKETS = 8


class ServingStore:
    """``name`` is the table's name in the catalog, from the root unless given; ``buckets`` is fixed when it is created."""

    def __init__(self, spark: SparkSession, root: str, name: str | None = None, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.name = name or "serving_" + hashlib.md5(self.root.encode()).hexdigest()[:12]
        self.buckets = buckets
        self.progress_path = f"{self.root}/progress"
        self.pending_path = f"{self.root}/pending"

    # -- reads ------------------------------------------------------------
    def rows(self) -> DataFrame:
        """The catalog's table; registered at its place where this catalog doesn't know it."""
        if not self.spark.catalog.tableExists(self.name):
            self.spark.sql(f"""CREATE TABLE IF NOT EXISTS {self.name} ({VERSION_SCHEMA}) USING parquet PARTITIONED BY (event_date)
                               CLUSTERED BY (device_id) SORTED BY (device_id, event_time) INTO {self.buckets} BUCKETS LOCATION '{self.root}/table'""")
            if folder_exists(self.spark, f"{self.root}/table"):
                self.spark.catalog.recoverPartitions(self.name)
        return self.spark.table(self.name)

    def table(self) -> DataFrame:
        """Current serving table: newest version of each key, with the load that wrote it."""
        return self.rows().select(*SERVING_COLUMNS, "batch_id")

    def series(self, device_id: str) -> DataFrame:
        """Key query: the device's bucket alone is read, of which row-group statistics skip the rest."""
        return device_series(self.rows(), device_id)

    def recent(self, since_ms: int) -> DataFrame:
        """Range scan; the event_date bound prunes whole date folders first."""
        since_day = (dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=since_ms)).date()
        return recent_scan(self.rows().where(F.col("event_date") >= F.lit(since_day)), since_ms)

    def progress(self) -> DataFrame:
        return read_or_empty(self.spark, self.progress_path, PROGRESS_SCHEMA).select(
            "batch_id", "last_event_ts", "rows_written", "source")

    def state(self, batch_id: int | None = None, source: str | None = None) -> tuple[dt.datetime | None, int | None, bool]:
        """(watermark, newest committed batch, whether ``batch_id`` or ``source`` is committed): one row
        reaches the driver however many loads ran."""
        this = F.lit(False)
        if batch_id is not None:
            this = this | (F.col("batch_id") == F.lit(batch_id))
        if source is not None:
            this = this | F.coalesce(F.col("source") == F.lit(source), F.lit(False))
        row = self.progress().agg(F.max_by("last_event_ts", "batch_id").alias("wm"), F.max("batch_id").alias("newest"),
                                  F.count_if(this).alias("seen")).first()
        return row.wm, row.newest, bool(row.seen)

    def watermark(self) -> dt.datetime | None:
        """last_event_ts of the newest committed load."""
        return self.state()[0]

    def is_committed(self, batch_id: int) -> bool:
        return self.state(batch_id)[2]

    # -- writes -----------------------------------------------------------
    def _pending(self, batch_id: int) -> str:
        return f"{self.pending_path}/batch_id={batch_id}"

    def finish(self, newest: int | None) -> None:
        """Finish the newest committed load if it died before its days were in the table."""
        if newest is not None and folder_exists(self.spark, self._pending(newest)):
            self._replace_days(newest)

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        """Write one load's serving rows (already projected), merged into the days that they touch, to ``pending``."""
        newest = self.state()[1]
        if newest is not None and batch_id <= newest:
            raise ValueError(f"batch {batch_id} isn't after the newest committed batch {newest}")
        self.finish(newest)
        new = rows.select(*SERVING_COLUMNS).select(
            "*", F.lit(batch_id).cast("bigint").alias("batch_id"), F.to_date(epoch_millis_to_ntz(F.col("event_time"))).alias("event_date"))
        # Stored, so that the days and the rows are those of one evaluation.
        checkpoint_root(self.spark)
        new = new.checkpoint()
        touched = self.rows().join(new.select("event_date").distinct(), "event_date", "left_semi").select(new.columns)
        latest_per_key(touched.unionByName(new)).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self._pending(batch_id))

    def commit(self, batch_id: int, watermark: dt.datetime, source: str | None = None) -> None:
        """Record the load (newest event_ts that it wrote, or the old mark), then bring its days into the table."""
        own = self._merged(batch_id).where(F.col("batch_id") == F.lit(batch_id))
        marker = own.agg(
            F.greatest(ntz_literal(watermark), F.max(F.to_timestamp_ntz("event_ts"))).alias("last_event_ts"),
            F.count(F.lit(1)).alias("rows_written"),
        ).withColumn("source", F.lit(source).cast("string"))
        (
            marker.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static")
            .parquet(f"{self.progress_path}/batch_id={batch_id}")
        )
        self._replace_days(batch_id)

    def _merged(self, batch_id: int) -> DataFrame:
        return self.spark.read.schema(VERSION_SCHEMA).parquet(self._pending(batch_id))

    def _replace_days(self, batch_id: int) -> None:
        """The pending days in place of the table's. Range partitioning cuts a day or a device with many rows into
        evenly sized tasks; a bucket then has several files."""
        columns = self.rows().columns
        bucket = F.pmod(F.hash("device_id"), F.lit(self.buckets))
        dealt = self._merged(batch_id).select(*columns).repartitionByRange("event_date", bucket, "device_id", "event_time")
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            dealt.write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(mode, before)
        delete_folders(self.spark, [self._pending(batch_id)])


def load_increment(store: ServingStore, validated: DataFrame, as_of: dt.datetime, batch_id: int) -> bool:
    """One scheduled load: watermark -> read newer silver rows -> write -> advance mark.

    Returns False when ``batch_id`` is already committed (a repeated trigger is a no-op).
    """
    watermark, newest, committed = store.state(batch_id)
    if committed:
        store.finish(newest)
        return False
    watermark = watermark or first_run_watermark(as_of)
    newer = after_mark(validated, watermark)
    store.write_batch(serving_rows(newer), batch_id)
    store.commit(batch_id, watermark)
    return True


def load_epoch(store: ServingStore, validated: DataFrame, source: str) -> bool:
    """One micro-batch of a stream, named ``source`` (stream and epoch): committed once, under the next free batch id.

    A new stream's epochs start at 0 again, and loads of other streams or
    schedules may come between, so epochs aren't batch ids.
    """
    watermark, newest, committed = store.state(source=source)
    if committed:
        store.finish(newest)
        return False
    batch_id = 0 if newest is None else newest + 1
    store.write_batch(serving_rows(validated), batch_id)
    store.commit(batch_id, watermark or dt.datetime(1970, 1, 1), source)
    return True

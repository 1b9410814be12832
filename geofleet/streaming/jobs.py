"""Streaming jobs. Each takes a streaming DataFrame: a topic's records
(``sources.topics.read_topic``), or any other source with the same columns.

Sinks are exactly-once through the checkpoint (file sink) or idempotent per
batch id (``foreachBatch`` writers). No job limits its input's rate; a trigger
takes what has arrived.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from geofleet import constants as K
from geofleet.functions.time import epoch_millis_to_ntz, instant_to_ntz
from geofleet.operators import archive as A
from geofleet.operators.ingest import accepted_readings, decode_envelope, normalise_readings, rejected_readings, route_topic, sink_rows
from geofleet.operators.medallion import stage_events, validate_events
from geofleet.plans.serving_job import ServingStore, load_epoch
from geofleet.sources.cdc import cdc_images, cdc_rejects, cdc_rows


def _start(writer: DataStreamWriter, checkpoint: str, available_now: bool, interval: str) -> DataStreamWriter:
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def _replace(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch's folder; a replay replaces all of it."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def bronze_stream(feed: DataFrame, out: str, rejects: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Change feed(key, value) -> bronze rows; images that can't be read go to ``rejects``. Flushed every 10 s."""

    def write(batch: DataFrame, batch_id: int) -> None:
        images = cdc_images(batch).persist()
        try:
            _replace(cdc_rows(images), out, batch_id)
            _replace(cdc_rejects(images), rejects, batch_id)
        finally:
            images.unpersist()

    return _start(feed.writeStream.foreachBatch(write), checkpoint, available_now, f"{K.BRONZE_FLUSH_SECONDS} seconds").start()


def silver_stream(bronze: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Bronze rows -> staging -> silver, appended as they arrive (stateless, so late rows are tagged, not dropped)."""
    silver = validate_events(stage_events(bronze))
    return _start(silver.writeStream.format("parquet").outputMode("append"), checkpoint, available_now, K.SERVING_LOAD_INTERVAL).start(out)


def archive_stream(records: DataFrame, out: str, checkpoint: str, records_per_file: int, clock: str = "arrival",
                   available_now: bool = True) -> StreamingQuery:
    """Event topic(value) -> hourly archive of envelope JSON lines.

    ``clock='arrival'`` partitions on the micro-batch's processing time (the
    connector default), ``clock='event'`` on the reading's own timestamp, in the envelope.
    """
    if clock == "event":
        millis = F.get_json_object("value", "$.payload.timestamp").try_cast("bigint")
        at = F.coalesce(epoch_millis_to_ntz(millis), instant_to_ntz(F.current_timestamp()))
    else:
        at = instant_to_ntz(F.current_timestamp())
    writer = A.with_archive_partition(records.select("value"), at).writeStream.format("text").option("maxRecordsPerFile", records_per_file)
    return _start(writer.partitionBy(*A.PARTITION_COLUMNS), checkpoint, available_now, "1 minute").start(out)


def ingest_stream(messages: DataFrame, table_path: str, rejects_path: str, checkpoint: str, available_now: bool = True,
                  ingested_at: dt.datetime | None = None) -> StreamingQuery:
    """Raw messages(msg_id, topic, payload) -> route -> normalise -> rows of the source table; rejects to their own folder.

    ``ingested_at`` is the clock at which each micro-batch runs unless given.
    """
    normalised = normalise_readings(route_topic(messages))

    def write(batch: DataFrame, batch_id: int) -> None:
        # Two outputs read the batch: keep it (a lost block is recomputed
        # from the source), and release it even when a write fails.
        batch.persist()
        try:
            at = ingested_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            _replace(sink_rows(accepted_readings(batch), at), table_path, batch_id)
            _replace(rejected_readings(batch), rejects_path, batch_id)
        finally:
            batch.unpersist()

    return _start(normalised.writeStream.foreachBatch(write), checkpoint, available_now, "1 minute").start()


def table_sink_stream(events_topic: DataFrame, table_path: str, checkpoint: str, available_now: bool = True,
                      ingested_at: dt.datetime | None = None) -> StreamingQuery:
    """Event topic(value, msg_id) -> decoded envelope -> rows appended to the relational table.

    ``id`` is the record's msg_id, so a replayed batch produces the same ids
    and replaces its own folder.
    """
    decoded = decode_envelope(events_topic)

    def write(batch: DataFrame, batch_id: int) -> None:
        _replace(sink_rows(batch, ingested_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)), table_path, batch_id)

    return _start(decoded.writeStream.foreachBatch(write), checkpoint, available_now, "1 minute").start()


def serving_stream(silver: DataFrame, store: ServingStore, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Silver rows -> serving table, one store version per micro-batch.

    The stream's own checkpoint replaces the high-water mark, so a row that
    lands behind the newest event time is still loaded. A store may be fed by
    several streams and scheduled loads, one at a time.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        load_epoch(store, batch, f"{checkpoint}#{epoch}")

    return _start(silver.writeStream.foreachBatch(write), checkpoint, available_now, K.SERVING_LOAD_INTERVAL).start()


def table_stream(spark: SparkSession, path: str) -> DataFrame:
    """A folder of Parquet files as a stream, with the schema they have now. batch_id folders are read through."""
    return spark.readStream.schema(spark.read.parquet(path).drop("batch_id").schema).option("recursiveFileLookup", "true").parquet(path)

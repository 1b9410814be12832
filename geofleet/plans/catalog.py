"""Registered queries: (spark, sf_dir) -> DataFrame, one per operator.

Every query starts from the driver's ``events`` table (through the fixture
views) and runs over all of it. "Now" is fixed at AS_OF so trailing windows
are reproducible; averages are rounded to 9 places only at the output, as
float summation order differs between engines.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geofleet import constants as K
from geofleet.operators import archive as A
from geofleet.operators import dashboard as D
from geofleet.operators import ingest as I
from geofleet.operators import quality as Q
from geofleet.operators import serving as S
from geofleet.operators.medallion import device_daily, stage_events, validate_events
from geofleet.operators.newest import distinct_rows
from geofleet.plans.medallion_build import build_medallion, table_counts
from geofleet.plans.serving_job import ServingStore, load_increment
from geofleet.session import scratch_path
from geofleet.sources.cdc import cdc_current, cdc_images, cdc_rejects, unwrap_cdc
from geofleet.sources.files import stored_counts
from geofleet.sources.fixtures import (
    broken_tables,
    cdc_messages,
    damaged_cdc_messages,
    device_messages,
    events_to_messages,
    events_to_source,
    source_events,
    source_to_cdc,
)
from geofleet.sources.tables import read_table, stream_table
from geofleet.sources.topics import publish, read_topic
from geofleet.functions.time import epoch_millis_to_ntz, ntz_literal
from geofleet.streaming import jobs as J
from geofleet.streaming import state as W

AS_OF = dt.datetime(2024, 1, 30, 0, 0, 0)
SERIES_DEVICE = "device-001"
SERVING_RELOAD_DAYS = 7           # the upsert query re-loads the last week ...
SERVING_UPDATE_SHIFT = 0.001      # ... with corrected (moved) latitudes
ARCHIVE_OBJECT_RECORDS = 100_000  # objects of tens of MB, where the ten-record layout isn't the point

SLICE_DAYS_AGO = (21, 13, 6)      # streams with state read the table in slices that end so many days before now
DISTINCT_DELAY = "1 day"
WINDOW_DELAY = "2 hours"

Query = Callable[[SparkSession, str], DataFrame]


# --- shared building blocks ---------------------------------------------------
def silver(spark: SparkSession, sf: str) -> DataFrame:
    return validate_events(stage_events(source_events(spark, sf)))


def gold(spark: SparkSession, sf: str) -> DataFrame:
    return device_daily(silver(spark, sf))


def latest(spark: SparkSession, sf: str) -> DataFrame:
    return D.latest_position(silver(spark, sf))


def serving_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Serving table after one full load of silver."""
    return S.latest_per_key(S.serving_rows(silver(spark, sf)))


def routed(spark: SparkSession, sf: str) -> DataFrame:
    return I.route_topic(device_messages(spark, sf))


def normalised(spark: SparkSession, sf: str) -> DataFrame:
    return I.normalise_readings(routed(spark, sf))


def accepted(spark: SparkSession, sf: str) -> DataFrame:
    return I.accepted_readings(normalised(spark, sf))


def archive_records(spark: SparkSession, sf: str) -> DataFrame:
    """Enveloped records with the hour partition of their event time. Messages are dealt evenly before they are parsed:
    a table's file may have too few splits for work that costs so much more than its bytes."""
    rec = I.envelope(I.accepted_readings(I.normalise_readings(routed(spark, sf).hint("rebalance"))))
    return A.with_archive_partition(rec, epoch_millis_to_ntz(F.col("timestamp")))


def _round9(df: DataFrame, *cols: str) -> DataFrame:
    """Round to 9 places; '+ 0.0' turns a rounded -0.0 into 0.0 so engines agree."""
    return df.select(*[(F.round(c, 9) + F.lit(0.0)).alias(c) if c in cols else F.col(c) for c in df.columns])


# --- medallion ----------------------------------------------------------------
def q_stg_events(spark, sf):
    return stage_events(source_events(spark, sf))


def q_silver_validated(spark, sf):
    return silver(spark, sf)


def q_device_daily(spark, sf):
    return _round9(gold(spark, sf), "avg_latitude", "avg_longitude")


def q_medallion_build(spark, sf):
    return table_counts(spark, built_medallion(spark, sf))


def built_medallion(spark: SparkSession, sf: str, metrics: dict | None = None, paths: dict[str, str] | None = None) -> dict[str, str]:
    """The three layers built from a bronze folder, under databases of this run's own."""
    root = scratch_path(spark, "medallion")
    source_events(spark, sf).write.parquet(f"{root}/bronze")
    run = root.rsplit("-", 1)[1]
    if paths is not None:
        paths["bronze"] = f"{root}/bronze"
    return build_medallion(spark, f"{root}/bronze", root, {k: f"{v}_{run}" for k, v in K.LAYER_SCHEMAS.items()}, metrics, paths)


# --- dashboard ----------------------------------------------------------------
def q_latest_position(spark, sf):
    return latest(spark, sf)


def q_hourly_trend(spark, sf):
    return D.hourly_trend(silver(spark, sf), AS_OF)


def q_daily_listing(spark, sf):
    return D.daily_listing(gold(spark, sf))


def q_top_devices(spark, sf):
    return D.top_devices(gold(spark, sf))


def q_map_center(spark, sf):
    return _round9(D.map_center(latest(spark, sf)), "center_latitude", "center_longitude")


def q_active_devices(spark, sf):
    return D.devices_shown(silver(spark, sf))


def q_device_palette(spark, sf):
    return D.device_palette(D.devices_shown(silver(spark, sf)))


# --- data quality -------------------------------------------------------------
def _checks(kind: str) -> Query:
    def run(spark, sf):
        s = silver(spark, sf)
        tables = {"iot_validated": s, "device_daily": device_daily(s)}
        return Q.run_checks(tables, tuple(c for c in Q.DEFAULT_CHECKS if c.kind == kind))
    return run


def q_dq_broken(spark, sf):
    """All nine checks over tables that break each of them."""
    return Q.run_checks(broken_tables(spark, sf))


# --- serving ------------------------------------------------------------------
def q_incremental_read(spark, sf):
    return S.incremental_read(silver(spark, sf), S.first_run_watermark(AS_OF))


def q_serving_rows(spark, sf):
    return S.serving_rows(silver(spark, sf))


def q_serving_upsert(spark, sf):
    """Full load, then a re-load of the last week with corrected latitudes: the
    re-loaded keys take batch 2's values, every other key keeps batch 1's."""
    s = silver(spark, sf)
    first = S.serving_rows(s).withColumn("batch_id", F.lit(1).cast("bigint"))
    since = AS_OF - dt.timedelta(days=SERVING_RELOAD_DAYS)
    resent = s.where(F.col("event_ts") >= ntz_literal(since)).withColumn(
        "latitude", F.col("latitude") + F.lit(SERVING_UPDATE_SHIFT))
    return S.upsert(first, S.serving_rows(resent), batch_id=2)


def q_serving_load(spark, sf):
    """Two scheduled loads into the serving table: data known at 01-29, then everything. The second is
    tried once before with other rows and dies before its commit."""
    s = silver(spark, sf)
    store = ServingStore(spark, scratch_path(spark, "serving"))
    first_as_of = AS_OF - dt.timedelta(days=1)
    load_increment(store, s.where(F.col("event_ts") <= ntz_literal(first_as_of)), first_as_of, 1)
    store.write_batch(S.serving_rows(s), 2)
    load_increment(store, s, AS_OF, 2)
    load_increment(store, s, AS_OF, 2)   # repeated trigger: no-op
    return store.table()


def q_bucketed_series(spark, sf):
    """The key query over the loaded serving table: one bucket of it is read."""
    store = ServingStore(spark, scratch_path(spark, "serving"))
    store.write_batch(S.serving_rows(silver(spark, sf)), 1)
    store.commit(1, AS_OF)
    return store.series(SERIES_DEVICE)


def q_advance_watermark(spark, sf):
    wm = S.first_run_watermark(AS_OF)
    return S.advance_watermark(S.after_mark(silver(spark, sf), wm), wm)


def q_device_series(spark, sf):
    return S.device_series(serving_snapshot(spark, sf), SERIES_DEVICE)


def _since_ms() -> int:
    return S.epoch_ms(AS_OF - dt.timedelta(hours=K.RECENT_WINDOW_HOURS))


def q_recent_scan(spark, sf):
    return S.recent_scan(serving_snapshot(spark, sf), _since_ms())


def q_device_count_1h(spark, sf):
    return S.device_counts(S.recent_scan(serving_snapshot(spark, sf), _since_ms()))


# --- ingest -------------------------------------------------------------------
def q_route_topic(spark, sf):
    return routed(spark, sf).select("msg_id", "topic")


def q_normalize_reading(spark, sf):
    return accepted(spark, sf)


def q_reject_readings(spark, sf):
    return I.rejected_readings(normalised(spark, sf)).select("msg_id", "reject_reason")


def q_envelope_roundtrip(spark, sf):
    return I.decode_envelope(I.envelope(accepted(spark, sf)))


def q_keyed_publish(spark, sf):
    """The event topic kept as a table: each record's partition, and its place there by arrival."""
    return I.keyed_publish(I.envelope(accepted(spark, sf))).select("msg_id", "key", "partition", "offset")


def q_ingest_events(spark, sf):
    """Raw messages through the ingest stream into the relational table, and back."""
    return _run_stream(spark, "ingest", lambda out, ck: J.ingest_stream(
        events_to_messages(stream_table(spark, sf, "events")), out, f"{out}-rejects", ck, ingested_at=AS_OF), "batch_id")


def q_append_rows(spark, sf):
    """The event topic through the append sink, once more into a table that holds a first load."""
    records = I.envelope(accepted(spark, sf))

    def start(out: str, ck: str):
        I.sink_rows(I.decode_envelope(records.where("msg_id < 100")), AS_OF).write.parquet(f"{out}/batch_id=-1")
        later = I.envelope(I.accepted_readings(I.normalise_readings(I.route_topic(events_to_messages(stream_table(spark, sf, "events"))))))
        return J.table_sink_stream(later.where("msg_id >= 100"), out, ck, ingested_at=AS_OF)

    return _run_stream(spark, "append", start, "batch_id")


# --- change feed, bronze, streams ----------------------------------------------
def q_cdc_unwrap(spark, sf):
    return unwrap_cdc(cdc_messages(spark, sf))


def q_cdc_rejects(spark, sf):
    """Images of a damaged feed that can't be read."""
    return cdc_rejects(cdc_images(damaged_cdc_messages(spark, sf))).select("key", "reject_reason")


def _run_stream(spark, name: str, start, *dropped: str) -> DataFrame:
    root = scratch_path(spark, name)
    query = start(f"{root}/out", f"{root}/checkpoint")
    query.awaitTermination()
    return spark.read.parquet(f"{root}/out").drop(*dropped)


def silver_over_cdc(spark, sf) -> DataFrame:
    """Silver built the way the warehouse builds it: over the bronze table the
    change feed fills (update images repeat an id; tombstones are all-NULL
    rows, dropped by the null filter)."""
    return validate_events(stage_events(unwrap_cdc(cdc_messages(spark, sf))))


def q_silver_from_cdc(spark, sf):
    return silver_over_cdc(spark, sf)


def q_dq_unique_cdc(spark, sf):
    """The unique(event_id) check over CDC-built silver: it fails once per updated row."""
    return Q.run_checks({"iot_validated": silver_over_cdc(spark, sf)},
                        tuple(c for c in Q.DEFAULT_CHECKS if c.kind == "unique"))


def q_bronze_append(spark, sf):
    feed = source_to_cdc(events_to_source(stream_table(spark, sf, "events")))
    return _run_stream(spark, "bronze", lambda out, ck: J.bronze_stream(feed, out, f"{out}-rejects", ck), "batch_id")


def q_stream_silver(spark, sf):
    bronze = events_to_source(stream_table(spark, sf, "events"))
    return _run_stream(spark, "silver-stream", lambda out, ck: J.silver_stream(bronze, out, ck))


# --- streams with state ---------------------------------------------------------
def _run_slices(spark, name: str, slices: list[DataFrame], start) -> str:
    """A feed that arrives in slices: after each, the stream is started again on its checkpoint and runs until it has read all. Its output."""
    root = scratch_path(spark, name)
    for rows in slices:
        rows.write.mode("append").parquet(f"{root}/feed")
        start(J.table_stream(spark, f"{root}/feed"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return f"{root}/out"


def _by_time(rows: DataFrame) -> list[DataFrame]:
    """Consecutive slices by event time; rows without one come with the first."""
    at, cuts = F.col("event_ts"), [ntz_literal(AS_OF - dt.timedelta(days=d)) for d in SLICE_DAYS_AGO]
    return [rows.where(at.isNull() | (at < cuts[0])), *[rows.where((at >= a) & (at < b)) for a, b in zip(cuts, cuts[1:])], rows.where(at >= cuts[-1])]


def replayed(rows: DataFrame) -> list[DataFrame]:
    """An at-least-once feed: each slice repeats rows of its own, of the slice before and of all earlier ones."""
    slices = _by_time(rows)
    out = []
    for i, own in enumerate(slices):
        again = [own.where("event_id % 5 = 0"), *[s.where("event_id % 7 = 0") for s in slices[max(0, i - 1):i]], *[s.where("event_id % 11 = 0") for s in slices[:i]]]
        out.append(functools.reduce(DataFrame.unionByName, [own, *again]))
    return out


def q_cdc_current(spark, sf):
    return cdc_current(cdc_messages(spark, sf))


def q_cdc_current_stream(spark, sf):
    """The latest image per id as keyed state; updates and deletes come in a later slice than their rows."""
    feed = cdc_messages(spark, sf)
    slices = [feed.where("position % 3 = 0"), feed.where("position % 3 = 1"), feed.where("position % 3 = 2")]
    return W.read_current_images(spark, _run_slices(spark, "current", slices, W.current_images_stream))


def q_dq_unique_current(spark, sf):
    """The unique(event_id) check over silver built from the latest images: it passes, where the append-only bronze fails."""
    current = validate_events(stage_events(cdc_current(cdc_messages(spark, sf))))
    return Q.run_checks({"iot_validated": current}, tuple(c for c in Q.DEFAULT_CHECKS if c.kind == "unique"))


def q_distinct_readings(spark, sf):
    rows = functools.reduce(DataFrame.unionByName, replayed(silver(spark, sf)))
    return distinct_rows(rows, ["device_id", "event_ts"], ["event_id"])


def q_distinct_readings_stream(spark, sf):
    start = functools.partial(W.distinct_stream, delay=DISTINCT_DELAY)
    return spark.read.parquet(_run_slices(spark, "distinct", replayed(silver(spark, sf)), start))


def _heartbeat(spark, sf) -> DataFrame:
    """A silver row without a device, some days after the last event: it closes the windows before it."""
    rows = silver(spark, sf)
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name != "event_ts"]
    later = (F.max("ts") + F.expr("INTERVAL 3 DAYS")).alias("event_ts")
    return read_table(spark, sf, "events").agg(later).select(*nulls, "event_ts").select(rows.columns)


def q_device_daily_stream(spark, sf):
    start = functools.partial(W.daily_stream, delay=WINDOW_DELAY)
    out = _run_slices(spark, "daily", [*_by_time(silver(spark, sf)), _heartbeat(spark, sf)], start)
    return _round9(spark.read.parquet(out), "avg_latitude", "avg_longitude")


def q_hourly_counts_stream(spark, sf):
    start = functools.partial(W.hourly_stream, delay=WINDOW_DELAY)
    return spark.read.parquet(_run_slices(spark, "hourly", [*_by_time(silver(spark, sf)), _heartbeat(spark, sf)], start))


def q_latest_position_stream(spark, sf):
    """The newest slice comes first, so all later ones are out of order."""
    out = _run_slices(spark, "latest", _by_time(silver(spark, sf))[::-1], W.latest_position_stream)
    return W.read_newest(spark, out, ["device_id"])


def q_topic_table(spark, sf):
    """Readings published to the event topic in two parts, subscribed to, and appended to the relational table."""
    root = scratch_path(spark, "topic")
    records = I.envelope(accepted(spark, sf)).withColumn("timestamp", F.timestamp_millis("timestamp"))
    for part in ("msg_id % 2 = 0", "msg_id % 2 = 1"):
        publish(records.where(part), K.EVENTS_TOPIC, folder=f"{root}/topics")
        topic = read_topic(spark, K.EVENTS_TOPIC, folder=f"{root}/topics")
        J.table_sink_stream(topic, f"{root}/out", f"{root}/checkpoint", ingested_at=AS_OF).awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("batch_id")


# --- archive and counts ---------------------------------------------------------
def _written_archive(spark, sf, records_per_file: int = ARCHIVE_OBJECT_RECORDS) -> str:
    path = scratch_path(spark, "archive")
    A.write_archive(archive_records(spark, sf), path, records_per_file)
    return path


def q_archive_hourly(spark, sf):
    """The archive written in the ten-record layout and read back: records per hour, and whether its objects keep to the limit."""
    objects = A.archive_objects(spark, _written_archive(spark, sf, K.ARCHIVE_RECORDS_PER_FILE))
    return objects.select(*A.PARTITION_COLUMNS, "record_count", (F.col("largest_object") <= K.ARCHIVE_RECORDS_PER_FILE).alias("within_limit"),
                          (F.col("object_count") * K.ARCHIVE_RECORDS_PER_FILE >= F.col("record_count")).alias("enough_objects"))


def q_archive_restore(spark, sf):
    """The archive written, read back and decoded."""
    return I.decode_envelope(A.read_archive(spark, _written_archive(spark, sf)))


def q_retention_14d(spark, sf):
    """The archive written, expired as of now, and counted by hour."""
    path = _written_archive(spark, sf)
    A.expire_archive(spark, path, AS_OF)
    return A.hourly_counts(A.read_archive(spark, path))


def q_layer_counts(spark, sf):
    """Rows per stored layer, each counted where it is stored: Parquet layers from their footers (staging is a view of
    bronze without a filter), the archive's from its lines."""
    paths: dict[str, str] = {}
    names = built_medallion(spark, sf, paths=paths)
    store = ServingStore(spark, scratch_path(spark, "serving"))
    store.write_batch(S.serving_rows(spark.table(names["silver"])), 1)
    store.commit(1, AS_OF)
    stored = stored_counts(spark, {"iot_events": paths["bronze"], "stg_iot_events": paths["bronze"], "iot_validated": paths["silver"],
                                   "device_daily": paths["gold"], "serving": f"{store.root}/table"})
    archive = A.read_archive(spark, _written_archive(spark, sf))
    lines = archive.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit("archive_records").alias("layer"), "row_count")
    return spark.createDataFrame(stored.collect(), "layer STRING, row_count BIGINT").unionByName(lines)  # five rows


def q_dq_while_writing(spark, sf):
    """All nine checks of a build: column checks from what its writes counted, unique keys by grouping its tables."""
    metrics: dict = {}
    names = built_medallion(spark, sf, metrics)
    return Q.checks_after_write(spark, {"iot_validated": spark.table(names["silver"]), "device_daily": spark.table(names["gold"])}, metrics)


def _utc(fn: Query) -> Query:
    """Pin the session zone before planning: NTZ text formatting at the edges
    (ISO text, archive hour folders) must not shift with a caller's zone."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


_QUERIES: dict[str, Query] = {
    "stg_events": q_stg_events,
    "silver_validated": q_silver_validated,
    "device_daily": q_device_daily,
    "medallion_build": q_medallion_build,
    "latest_position": q_latest_position,
    "hourly_trend": q_hourly_trend,
    "daily_listing": q_daily_listing,
    "top_devices": q_top_devices,
    "map_center": q_map_center,
    "active_devices": q_active_devices,
    "device_palette": q_device_palette,
    "dq_not_null": _checks("not_null"),
    "dq_unique": _checks("unique"),
    "dq_accepted": _checks("accepted_values"),
    "dq_unique_combo": _checks("unique_combination"),
    "dq_broken": q_dq_broken,
    "dq_while_writing": q_dq_while_writing,
    "incremental_read": q_incremental_read,
    "serving_rows": q_serving_rows,
    "serving_upsert": q_serving_upsert,
    "serving_load": q_serving_load,
    "advance_watermark": q_advance_watermark,
    "device_series": q_device_series,
    "recent_scan": q_recent_scan,
    "device_count_1h": q_device_count_1h,
    "route_topic": q_route_topic,
    "normalize_reading": q_normalize_reading,
    "reject_readings": q_reject_readings,
    "envelope_roundtrip": q_envelope_roundtrip,
    "keyed_publish": q_keyed_publish,
    "ingest_events": q_ingest_events,
    "append_rows": q_append_rows,
    "cdc_unwrap": q_cdc_unwrap,
    "cdc_rejects": q_cdc_rejects,
    "bronze_append": q_bronze_append,
    "silver_from_cdc": q_silver_from_cdc,
    "dq_unique_cdc": q_dq_unique_cdc,
    "stream_silver": q_stream_silver,
    "cdc_current": q_cdc_current,
    "cdc_current_stream": q_cdc_current_stream,
    "dq_unique_current": q_dq_unique_current,
    "distinct_readings": q_distinct_readings,
    "distinct_readings_stream": q_distinct_readings_stream,
    "device_daily_stream": q_device_daily_stream,
    "hourly_counts_stream": q_hourly_counts_stream,
    "latest_position_stream": q_latest_position_stream,
    "topic_table": q_topic_table,
    "bucketed_series": q_bucketed_series,
    "archive_hourly": q_archive_hourly,
    "archive_restore": q_archive_restore,
    "retention_14d": q_retention_14d,
    "layer_counts": q_layer_counts,
}

QUERIES: dict[str, Query] = {name: _utc(fn) for name, fn in _QUERIES.items()}

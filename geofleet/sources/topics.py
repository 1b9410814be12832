"""Topic edge: publish to and subscribe to a named topic.

With ``bootstrap`` set, Spark's Kafka source and sink are used (the connector
jar must be on the classpath); partitions and offsets are the broker's.
Without it a folder of JSON lines (key, value, timestamp) for each topic
stands in, written and read by Spark's plain file sink and source.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_SCHEMA = "key STRING, value STRING, timestamp TIMESTAMP, msg_id BIGINT"
# Offsets of a partition stay below 2**40, so (partition, offset) packs into one id.
OFFSET_BITS = 40


def record_id(partition: str = "partition", offset: str = "offset") -> Column:
    """Stable surrogate id of a broker's record (survives task retries and replays)."""
    return F.shiftleft(F.col(partition).cast("bigint"), OFFSET_BITS) + F.col(offset)


def read_topic(spark: SparkSession, topic: str, *, bootstrap: str | None = None, folder: str | None = None,
               starting_offsets: str = "earliest") -> DataFrame:
    """Streaming subscription to ``topic``: key, value, topic, timestamp, msg_id (unique per record). No rate limit."""
    if bootstrap:
        records = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
                   .option("subscribe", topic).option("startingOffsets", starting_offsets).load())
        return records.select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", "timestamp",
                              record_id().alias("msg_id"))
    if not folder:
        raise ValueError("either bootstrap or folder is required")
    records = spark.readStream.schema(RECORD_SCHEMA).json(f"{folder.rstrip('/')}/{topic}")
    return records.select("key", "value", F.lit(topic).alias("topic"), "timestamp", "msg_id")


def time_slices(records: DataFrame, slice_rows: int) -> list[tuple[int | None, int | None]]:
    """Consecutive ranges [from, to) of msg_id (open at the ends), so that no key has much more than ``slice_rows`` rows in one.

    One number, the rows of the largest key, decides how many; the bounds are quantiles of that key's msg_id.
    """
    top = records.groupBy("key").count().orderBy(F.desc("count"), "key").first()
    if top is None or top["count"] <= slice_rows:
        return [(None, None)]
    n = -(-top["count"] // slice_rows)
    own = records.where(F.col("key").eqNullSafe(F.lit(top["key"])))
    cuts = sorted({int(x) for x in own.approxQuantile("msg_id", [i / n for i in range(1, n)], 0.1 / n)})
    return list(zip([None, *cuts], [*cuts, None]))


def publish(records: DataFrame, topic: str, *, bootstrap: str | None = None, folder: str | None = None,
            slice_rows: int = 1_000_000, write: Callable[[DataFrame], None] | None = None) -> int:
    """Publish records(key, value, timestamp, msg_id) to ``topic``, each key's in order of msg_id; how many slices it took.

    A key's records go through one task, sorted, so they reach the topic in
    order. A key with more than ``slice_rows`` records is published in
    consecutive slices, one job after another: no task holds it all.
    """
    if write is None:
        if bootstrap:
            def write(part: DataFrame) -> None:
                (part.select(F.col("key").cast("string"), F.col("value").cast("string")).write.format("kafka")
                 .option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())
        elif folder:
            def write(part: DataFrame) -> None:
                part.select("key", "value", "timestamp", "msg_id").write.mode("append").json(f"{folder.rstrip('/')}/{topic}")
        else:
            raise ValueError("either bootstrap or folder is required")
    slices = time_slices(records, slice_rows)
    for low, high in slices:
        part = records
        if low is not None:
            part = part.where(F.col("msg_id") >= low)
        if high is not None:
            part = part.where(F.col("msg_id") < high)
        write(part.repartition("key").sortWithinPartitions("key", "msg_id"))
    return len(slices)

"""Parquet tables of a scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


# Declared schemas of the tables geofleet reads: no footer-inference job per
# read, and a changed upstream type fails at the scan instead of downstream.
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Batch scan of one table; Catalyst prunes columns and pushes filters into it."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(table_path(sf_dir, name))


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a streaming file source (stand-in for a topic).

    The file source needs a directory or a glob, so the file name is given
    as a one-character class glob; new files matching it are picked up as
    new micro-batches.
    """
    schema = SCHEMAS.get(name) or spark.read.parquet(table_path(sf_dir, name)).schema
    glob = f"{sf_dir.rstrip('/')}/{name[:-1]}[{name[-1]}].parquet"
    return spark.readStream.schema(schema).parquet(glob)

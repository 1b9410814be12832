"""Materialise the three layers.

bronze is an existing table or Parquet folder; staging is a view over it
(Catalyst inlines it into silver's plan); silver and gold are full rebuilds.
A build writes its tables into folders of its own beside those in use; the catalog
names are views over these folders, each replaced in one statement, so a reader sees
the old table whole or the new one. Gold is computed from the *written* silver table, so its job starts from files
rather than re-running silver's lineage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from geofleet import constants as K
from geofleet.operators.medallion import device_daily, staging_exprs, validate_events
from geofleet.operators.quality import observed

BRONZE_TABLE = "iot_events"
STAGING_VIEW = "stg_iot_events"
SILVER_TABLE = "iot_validated"
GOLD_TABLE = "device_daily"


def _over_folder(spark: SparkSession, name: str, path: str) -> None:
    """Point a catalog name at a folder of Parquet files, in one statement. Metadata only: the files stay as they are."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")


def build_medallion(spark: SparkSession, bronze: str, root: str, schemas: dict[str, str] | None = None,
                    metrics: dict[str, Observation] | None = None, paths: dict[str, str] | None = None) -> dict[str, str]:
    """Build staging view, silver and gold; their qualified names by layer.

    ``metrics`` is given what the writes count of the declared checks (``quality.checks_after_write``), ``paths`` the folders of silver and gold.

    ``bronze`` is a table name, or the path of a Parquet folder (it has a
    slash), which is registered where it lies and not copied. ``schemas``
    gives the catalog's database of each layer: runs at the same time on one
    catalog need different ones.
    """
    schemas, root, build = schemas or K.LAYER_SCHEMAS, root.rstrip("/"), uuid.uuid4().hex[:12]
    raw, clean, analytics = (schemas[k] for k in ("staging", "silver", "gold"))
    for db in (raw, clean, analytics):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/{db}'")
    if "/" in bronze:
        bronze_name = f"{raw}.{BRONZE_TABLE}"
        _over_folder(spark, bronze_name, bronze)
    else:
        bronze_name = bronze
    names = {"bronze": bronze_name, "staging": f"{raw}.{STAGING_VIEW}", "silver": f"{clean}.{SILVER_TABLE}", "gold": f"{analytics}.{GOLD_TABLE}"}
    exprs = ", ".join(staging_exprs(spark.table(bronze_name).schema))
    spark.sql(f"CREATE OR REPLACE VIEW {names['staging']} AS SELECT {exprs} FROM {bronze_name}")
    # Silver is partitioned by event_date, so time-bounded reads (the
    # incremental load, trailing windows) prune whole days, and clustered by
    # device and time inside a day, so key reads skip row groups by min/max
    # statistics. Range partitioning on (event_date, device_id, event_ts)
    # cuts a device holding a third of all rows into many tasks by time,
    # where hash partitioning on device_id would give it a single task.
    silver_path, gold_path = (f"{root}/{x}/build={build}" for x in (SILVER_TABLE, GOLD_TABLE))
    silver, silver_metrics = observed(
        validate_events(spark.table(names["staging"]))
        .withColumn("event_date", F.col("event_ts").cast("date"))
        .repartitionByRange("event_date", "device_id", "event_ts")
        .sortWithinPartitions("event_date", "device_id", "event_ts"), SILVER_TABLE)
    silver.write.partitionBy("event_date").parquet(silver_path)
    gold, gold_metrics = observed(device_daily(spark.read.parquet(silver_path).drop("event_date")), GOLD_TABLE)
    gold.write.parquet(gold_path)
    if metrics is not None:
        metrics |= {SILVER_TABLE: silver_metrics, GOLD_TABLE: gold_metrics}
    if paths is not None:
        paths |= {"silver": silver_path, "gold": gold_path}
    _over_folder(spark, names["silver"], silver_path)
    _over_folder(spark, names["gold"], gold_path)
    return names


def built_tables(spark: SparkSession, schemas: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """silver and gold of the last build, by their names in the catalog."""
    schemas = schemas or K.LAYER_SCHEMAS
    return {"silver": spark.table(f"{schemas['silver']}.{SILVER_TABLE}"), "gold": spark.table(f"{schemas['gold']}.{GOLD_TABLE}")}


def table_counts(spark: SparkSession, names: dict[str, str]) -> DataFrame:
    """(table_name, row_count) of a built medallion, computed by Spark from the tables, under the layers' usual names."""
    usual = {"staging": f"{K.LAYER_SCHEMAS['staging']}.{STAGING_VIEW}", "silver": f"{K.LAYER_SCHEMAS['silver']}.{SILVER_TABLE}",
             "gold": f"{K.LAYER_SCHEMAS['gold']}.{GOLD_TABLE}"}
    parts = [spark.table(names[layer]).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(shown).alias("table_name"), "row_count")
             for layer, shown in usual.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])

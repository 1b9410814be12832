"""Folders of the store that Spark writes to."""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def delete_folders(spark: SparkSession, paths: Iterable[str]) -> int:
    """Delete folders through the store's own file system; how many there were."""
    sc, gone = spark.sparkContext, 0
    for path in paths:
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True))
    return gone


def read_or_empty(spark: SparkSession, path: str, schema: str, base: str | None = None) -> DataFrame:
    """Parquet at ``path`` with a declared schema; no rows if the path isn't there. Any other error is raised."""
    try:
        reader = spark.read.schema(schema)
        return (reader.option("basePath", base) if base else reader).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def folder_exists(spark: SparkSession, path: str) -> bool:
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    return bool(folder.getFileSystem(sc._jsc.hadoopConfiguration()).exists(folder))


def mounted_path(spark: SparkSession, path: str) -> str | None:
    """The path of a folder as programs see it, where the store is a mounted file system (``file:``); None on any other store."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return folder.toUri().getPath() if system.getUri().getScheme() == "file" else None


def stored_counts(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """(layer, row_count) of Parquet folders from their footers: the count is pushed into the reader, and no column is read.

    This needs Spark's V2 Parquet reader, so a session of its own has it switched on.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    counts = [own.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(layer).alias("layer"), "row_count")
              for layer, path in folders.items()]
    return functools.reduce(DataFrame.unionByName, counts)

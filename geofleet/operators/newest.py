"""The newest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """``columns`` of each key's row of the greatest ``order`` (nulls least); on a stream, the same as keyed state.

    An aggregate, so every map task combines its rows of a key to one before the shuffle.
    """
    picked = F.max_by(F.struct(*columns), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_newest.{c}").alias(c) for c in columns])


def distinct_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per ``keys``, that of the least ``order``: repeats of an at-least-once feed removed."""
    columns = [c for c in df.columns if c not in keys]
    picked = F.min_by(F.struct(*columns), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(picked).select(*[c if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])

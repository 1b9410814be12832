"""Held-out split and bounded training samples for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(id_col: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, mod 5, is 0. A null id isn't."""
    return F.coalesce(F.crc32(id_col.cast("string")) % FOLDS == 0, F.lit(False))


def bounded_sample(rows: DataFrame, id_col: str, bound: int) -> DataFrame:
    """At most ``bound`` of ``rows``, those of least hash of ``id_col``: the same ones in every run.

    A threshold on the hash leaves about twice the bound, so the ordering that makes the bound exact never sees more.
    """
    total = rows.count()
    h = F.xxhash64(F.col(id_col))
    share = min(1.0, 2 * bound / max(total, 1))
    below = int(-(1 << 63) + share * ((1 << 64) - 1))
    near = rows.where(h <= F.lit(min(below, (1 << 63) - 1)))
    return near.orderBy(h, id_col).limit(bound)

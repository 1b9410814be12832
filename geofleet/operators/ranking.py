"""Global positions without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geofleet.session import checkpoint_root


def ordinal(df: DataFrame, order: list[str], id_col: str, out: str = "position", group: str | None = None,
            partitions: int | None = None) -> DataFrame:
    """``df`` with the 0-based position of each row in ``order``, restarting per ``group`` value.

    ``row_number()`` over an unpartitioned (or low-cardinality) window moves
    every row of a group into one task. Instead the id, group and order
    columns alone are range-partitioned on (group, order, id), sorted and
    numbered inside each partition, and *stored* (a reliable checkpoint), so
    both uses below see the same partitions, whatever columns they need.
    Adding the rows of earlier partitions of the group gives the position,
    which is joined back by ``id_col``.

    ``id_col`` is unique and not null; it breaks ties of ``order``. Numbering
    is an action, as Spark's own zipWithIndex is: the checkpoint runs here.
    """
    args = [partitions] if partitions else []
    by = [group] if group else []
    keys = list(dict.fromkeys([*by, *order, id_col]))
    checkpoint_root(df.sparkSession)
    numbered = (
        df.select(*keys).repartitionByRange(*args, *keys).sortWithinPartitions(*keys)
        .select(*dict.fromkeys([*by, id_col]), F.spark_partition_id().alias("_part"),
                F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"))
        .checkpoint(eager=True)
    )
    sizes = numbered.groupBy("_part", *by).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", *by, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"))
    # The left join keeps a null group's rows; they are one group to the window too.
    same = [numbered[c].eqNullSafe(offsets[c]) for c in ("_part", *by)]
    on = same[0] & same[1] if by else same[0]
    placed = numbered.join(offsets, on).select(numbered[id_col], (F.col("_offset") + F.col("_row")).alias(out))
    if set(df.columns) <= {id_col}:
        return placed
    return df.join(placed, id_col)


def sorted_position(df: DataFrame, key: str, out: str = "position", partitions: int | None = None) -> DataFrame:
    """0-based position of each row of ``df`` in ascending order of ``key``, which is unique and not null."""
    return ordinal(df, [key], key, out=out, partitions=partitions)

"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import geofleet
from geofleet.session import checkpoint_root
from geofleet.sources.files import delete_folders

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def row_struct(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that names added beside it cannot clash with them."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns])


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; every other character stays. All-ASCII texts take the quicker ``lower``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def for_workers(df: DataFrame) -> DataFrame:
    """``df``, once Python workers look for this package where the driver found it.

    Needed where the package is on a path (a checkout) and not installed; workers don't share the driver's sys.path.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(geofleet.__file__)))
    env = df.sparkSession.sparkContext.environment
    paths = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return df


def cut(df: DataFrame) -> DataFrame:
    """``df`` stored in the shared checkpoint folder: lineage ends here and a lost executor loses nothing."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_cut(df: DataFrame) -> None:
    """Delete the stored rows of a ``cut`` that nothing reads any more."""
    folder = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if folder.isDefined():
        delete_folders(df.sparkSession, [folder.get()])


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries made and run in here go as each query ends, not when the driver happens to collect its garbage.

    For queries whose result is stored; what isn't would be shuffled again for every use.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def salted_lookup(big: DataFrame, small: DataFrame, key: str, salt_from: str, salts: int = 32) -> DataFrame:
    """``big`` left-joined to ``small`` (one row per key), safe for a key that holds much of ``big``.

    The rows of ``big`` are dealt by (key, salt). ``small`` is first joined to the distinct (key, salt) pairs
    that occur, at most ``salts`` of one key, so neither join gathers a hot key in one task.
    """
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(salt_from), F.lit(salts)))
    pairs = salted.select(key, "_salt").distinct()
    return salted.join(pairs.join(small, key), [key, "_salt"], "left").drop("_salt")


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Connected components of ``edges(u, v)``: (node, label), nodes of one component sharing a label.

    Each round maps every node to the neighbour (or itself) of least random rank and contracts the edges;
    the ranks change by round, so paths and cliques alike shrink by a constant factor. Nodes without an edge to
    another node don't appear. Labels are nodes of the component, not its minimum. Each round is checkpointed.
    Nodes of many edges and labels of many nodes are split by adaptive execution's skew join: these joins have no
    aggregate on their key above them. (Salting each of them was tried: the longer plans of every round cost the driver 360 MB.)
    """
    live = cut(edges.where("u <> v").select("u", "v").distinct())
    found: DataFrame | None = None
    for turn in range(max_rounds):
        if live.isEmpty():
            break
        both = live.union(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("n"))
        step = cut(both.groupBy("u").agg(F.min(rank("v")).alias("m"))
                   .select(F.col("u").alias("node"), F.least(F.col("m"), rank("u"))["n"].alias("to")))
        found = step.toDF("node", "label") if found is None else cut(
            found.join(step.toDF("label", "to"), "label", "left").select("node", F.coalesce("to", "label").alias("label")))
        moved = live.join(step.toDF("u", "tu"), "u").join(step.toDF("v", "tv"), "v").where("tu <> tv")
        live = cut(moved.select(F.least("tu", "tv").alias("u"), F.greatest("tu", "tv").alias("v")).distinct())
    else:
        raise RuntimeError("components: edges are left after the last round")
    if found is None:
        return edges.select(F.col("u").alias("node"), F.col("u").alias("label")).limit(0)
    return found

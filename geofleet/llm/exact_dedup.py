"""Operator 6: exact duplicates by skew-safe combining. DataFrame functions only.

1. Locally: each map task combines the equal texts that it holds (partial aggregation keyed by the whole text).
2. Salted digest groups: what the tasks leave is dealt by (digest, salt, text). The salt splits only hot digests:
   those that hold at least 1 / ``hot_share`` of all rows, so at most ``hot_share`` digests, a list whose size is
   proven and that may be broadcast. A digest that isn't hot has one salt, and its group is complete after this step.
3. Globally: the salts' winners of each hot digest (at most ``salts`` rows for each text) are combined.

The grouping key holds the full content at every step: texts with the same digest but different content never meet.
Documents then look up their group by digest; should a digest stand for several texts, its documents are compared
by their whole text instead.

Defined results: a null text counts as empty; texts are equal when identical after lower-casing A-Z only; the row with the
largest id stays; null ids lose against any other, and rows without an id are kept only where no row of
their group has one; repeated rows (same id and text) count in group_size and share one verdict; empty input gives
no rows; extra columns are ignored by ``duplicate_groups`` and kept by ``drop_duplicates_exact``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geofleet.llm.common import ascii_lower, cut, row_struct, salted_lookup

SALTS = 32
HOT_SHARE = 10_000


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _digested(df: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    norm = df.select(F.col(id_col).cast("long").alias("doc_id"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"),
                     row_struct(df).alias("row"))
    return norm.withColumn("digest", digest(F.col("norm")))


def _hot(docs: DataFrame, hot_share: int) -> DataFrame:
    """Digests of at least 1 / hot_share of the rows (and two rows): at most hot_share of them."""
    least = max(2, -(-docs.count() // hot_share))
    return cut(docs.groupBy("digest").count().where(F.col("count") >= least).select("digest", F.lit(True).alias("is_hot")))


def _winners(docs: DataFrame, hot: DataFrame, salts: int, aggs: list[Column]) -> DataFrame:
    """Steps 1 and 2: one row per (digest, salt, norm). At most ``hot_share`` digests are broadcast."""
    marked = docs.join(F.broadcast(hot), "digest", "left").withColumn("is_hot", F.coalesce("is_hot", F.lit(False)))
    salt = F.when(F.col("is_hot"), F.pmod(F.xxhash64("doc_id"), F.lit(salts))).otherwise(F.lit(0))
    return marked.groupBy("digest", "is_hot", salt.alias("salt"), "norm").agg(*aggs)


def _classes(docs: DataFrame, hot: DataFrame, salts: int) -> DataFrame:
    """digest, keep_id, group_size of every class of equal texts (without norm).

    The winners are stored without their texts, but for the few of hot digests, which step 3 compares.
    """
    winners = _winners(docs, hot, salts, [F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")])
    stored = cut(winners.select("digest", "is_hot", "keep_id", "group_size", F.when(F.col("is_hot"), F.col("norm")).alias("norm")))
    merged = stored.where("is_hot").groupBy("digest", "norm").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    return stored.where("not is_hot").select("digest", "keep_id", "group_size").unionByName(merged.drop("norm"))


def duplicate_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
                     hot_share: int = HOT_SHARE, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    docs = _digested(df, id_col, text_col, digest).drop("row")
    sha = F.col("digest") if digest is sha256 else sha256(F.col("norm"))
    ids = cut(docs.select("doc_id", "digest", sha.alias("sha")))
    hot = _hot(ids, hot_share)
    classes = cut(_classes(docs, hot, salts))
    shared = cut(classes.groupBy("digest").count().where("count > 1").select("digest"))
    found = salted_lookup(ids, classes.join(shared, "digest", "left_anti"), "digest", "doc_id", salts)
    verdicts = found.where("group_size is not null").select("doc_id", "keep_id", "group_size", "sha")
    if not shared.isEmpty():  # a digest of several texts: its documents look their group up by the whole text
        alike = docs.join(shared, "digest", "left_semi")
        aggs = [F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
        by_text = _winners(alike, hot, salts, aggs).groupBy("norm").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        verdicts = verdicts.unionByName(salted_lookup(alike, by_text, "norm", "doc_id", salts).select(
            "doc_id", "keep_id", "group_size", sha256(F.col("norm")).alias("sha")))
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    return verdicts.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def drop_duplicates_exact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
                          hot_share: int = HOT_SHARE, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row of ``df`` for each group of equal texts, that of the largest id; all columns.

    The winner's whole row travels with its group, so no join brings the rows back. Of rows that tie
    on the id, the largest one stays, its columns compared in order (they must be of types with an order).
    """
    docs = _digested(df, id_col, text_col, digest)
    hot = _hot(docs.select("digest"), hot_share)
    best = [F.max(F.struct("doc_id", "row")).alias("best")]
    # Apart, so that only hot digests' winners are dealt a second time.
    done = _winners(docs.join(F.broadcast(hot), "digest", "left_anti"), hot, salts, best)
    merged = _winners(docs.join(F.broadcast(hot), "digest", "left_semi"), hot, salts, best).groupBy("digest", "norm").agg(F.max("best").alias("best"))
    return done.select("best.row.*").unionByName(merged.select("best.row.*"))

"""Operator 12: benchmark decontamination by winnowing. DataFrame functions only.

Windows have t = ``window`` words. Every window's k-grams are hashed, k = (t + 1) // 2, and its least hash is the window's
fingerprint; neighbouring windows of the same fingerprint are one entry (fingerprint, first, last window). Two equal windows
hold the same k-grams, so they have the same fingerprint: every span of t words or more that a document shares with an item is found.

1. Items: fingerprints and whole windows (``item_windows``). An item of fewer than t words is one window of its own length; each
   such length (at most t - 1) is winnowed by itself.
2. Documents: fingerprints of the whole text, equality-joined to the items' fingerprints.
3. Hits are extended to the windows that they stand for, and these are compared by their whole words.

Up to ``max_broadcast`` different fingerprints of items (counted) are broadcast, and no text is shuffled; more are joined by a shuffle of
(text digest, fingerprint) rows, salted, and only matched texts are shuffled to be extended. Hits are kept by text digest, so
copies of a text make one set of hits. Items are looked up once for every different set of windows, not once for each document.

Defined results: null texts have no words; a text without words has no hits; an item without words has no window; rows that share
an item id are one item; a null item id counts as an empty one; every document row is one result row, null ids and repeated
rows included; empty tables give no rows (documents) or no hits (items); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geofleet.llm.common import ascii_lower, cut, salted_lookup

WINDOW_WORDS = 10
#: Fingerprints of 8 bytes: some 32 MB as a hashed relation.
MAX_BROADCAST = 1_000_000
#: What separates words, after lower-casing A-Z.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for the row, also where lambdas inside refer to it."""
    return F.transform(F.array(value), body)[0]


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def words(norm: Column) -> Column:
    return F.array_remove(F.split(norm, GAP), "")


def fingerprints(found: Column, t: int) -> Column:
    """array<struct<t, h, first, last>>: the least k-gram hash of each window of ``t`` words, and the windows (from 0) that share it."""
    k = (t + 1) // 2
    windows = F.size(found) - (t - 1)

    def joined(m: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(m) - 1), lambda i: (i == 0) | (F.get(m, i) != F.get(m, i - 1)))
        return let(starts, lambda s: F.transform(s, lambda x, i: F.struct(
            F.lit(t).alias("t"), F.get(m, x).alias("h"), x.alias("first"), (F.coalesce(F.get(s, i + 1), F.size(m)) - 1).alias("last"))))

    least = lambda g: F.transform(F.sequence(F.lit(1), F.size(g) - (t - k)), lambda i: F.array_min(F.slice(g, i, t - k + 1)))
    grams = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.xxhash64(F.lit(t), F.slice(w, i, k)))
    prints = let(found, lambda w: let(grams(w), lambda g: let(least(g), joined)))
    return F.when(windows > 0, prints).otherwise(F.array().cast("array<struct<t:int,h:bigint,first:int,last:int>>"))


def _window_id(found: Column, start: Column, t: Column) -> Column:
    return F.sha2(F.concat_ws(" ", F.slice(found, start + 1, t)), 256)


def _windows(prints: DataFrame, *keys: str) -> DataFrame:
    """(keys, start, t, wid) of every window in rows of (keys, w, t, first, last)."""
    each = prints.select(*keys, "w", "t", F.explode(F.sequence("first", "last")).alias("start"))
    return each.select(*keys, "start", "t", _window_id(F.col("w"), F.col("start"), F.col("t")).alias("wid"))


def _prints(df: DataFrame, lengths: list[Column], *keys: str) -> DataFrame:
    """(keys, w, t, h, first, last): one row per fingerprint of every list in ``lengths``."""
    lists = lengths[0] if len(lengths) == 1 else F.concat(*lengths)
    return df.select(*keys, "w", F.explode(lists).alias("p")).select(*keys, "w", "p.*")


def item_windows(items: DataFrame, window: int = WINDOW_WORDS, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, t, h, wid): every window of every item with its fingerprint."""
    read = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words(normalised(F.col(text_col))).alias("w"))
    own = [F.when(F.size("w") == t if t < window else F.size("w") >= t, fingerprints(F.col("w"), t))
           .otherwise(F.array().cast("array<struct<t:int,h:bigint,first:int,last:int>>")) for t in range(1, window + 1)]
    prints = _prints(read, own, "item")
    each = prints.select("item", "w", "t", "h", F.explode(F.sequence("first", "last")).alias("start"))
    return each.select("item", "t", "h", _window_id(F.col("w"), F.col("start"), F.col("t")).alias("wid")).distinct()


def _candidates(docs: DataFrame, fps: DataFrame, lengths: list[int], few: bool) -> DataFrame:
    """(digest, w, t, first, last): the documents' fingerprints that occur among the items', with the text's words."""
    lists = [fingerprints(F.col("w"), t) for t in lengths]
    prints = _prints(docs, lists, "digest")
    if few:
        return prints.join(F.broadcast(fps), "h").drop("h")
    thin = prints.select("digest", "t", "h", "first", "last").distinct()
    matched = salted_lookup(thin, fps.withColumn("_known", F.lit(True)), "h", "digest").where("_known")
    ranges = matched.groupBy("digest").agg(F.collect_list(F.struct("t", "first", "last")).alias("p"))
    held = docs.join(ranges.select("digest"), "digest", "left_semi").dropDuplicates(["digest"])
    return held.join(ranges, "digest").select("digest", "w", F.explode("p").alias("p")).select("digest", "w", "p.*")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    none = F.sha2(F.lit(""), 256)
    norm = normalised(F.col(text_col))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(norm, 256)).alias("digest"), words(norm).alias("w"))
    known = cut(item_windows(items, window, item_id_col, item_text_col))
    fps = known.select("h").distinct()
    lengths = sorted(r.t for r in known.select("t").distinct().collect())  # at most ``window`` numbers
    rows = cut(read.select("doc_id", F.size("w").cast("long").alias("n_words"), "digest"))
    if not lengths:
        return rows.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
                           none.alias("items_sha256"), F.lit(False).alias("contaminated"))
    few = fps.limit(max_broadcast + 1).count() <= max_broadcast
    extended = cut(_windows(_candidates(read.select("digest", "w"), fps, lengths, few), "digest").distinct())  # read twice by the lookup
    wids = known.select("wid").distinct().withColumn("_known", F.lit(True))
    hits = cut(salted_lookup(extended, wids, "wid", "digest").where("_known").select("digest", "start", "t", "wid"))

    # Words inside the union of a text's windows: what each adds to those before it.
    before = Window.partitionBy("digest").orderBy("start", "t").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("t")
    added = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0))))
    texts = hits.select("digest", "wid", added.alias("added")).groupBy("digest").agg(
        F.sum("added").alias("n_hit"), F.array_sort(F.collect_set("wid")).alias("wids"))
    texts = cut(texts.withColumn("held", F.sha2(F.array_join("wids", ""), 256)))

    sets = texts.groupBy("held").agg(F.first("wids").alias("wids")).select("held", F.explode("wids").alias("wid"))
    named = sets.join(known.select("wid", "item").distinct(), "wid").select("held", "item").distinct()
    listed = named.groupBy("held").agg(F.array_sort(F.collect_list("item")).alias("items")).select(
        "held", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    verdicts = salted_lookup(texts.select("digest", "n_hit", "held"), listed, "held", "digest").drop("held")
    found = salted_lookup(rows, verdicts, "digest", "doc_id")
    return found.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                        F.coalesce("items_sha256", none).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))

"""Operator 10: SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into floor(k / 2) + 1 segments for a limit of k differing bits: were two or more bits to differ
in every segment, more than k would differ in all, so in some segment two linked fingerprints differ by one bit at
most. The index holds, of each segment, its variants with one bit deleted (a wildcard); segments equal but for one
bit share the variant that deletes this bit. For an even k the last segment needs no wildcard: if every other
segment differs in two bits or more, nothing is left for it, so it is equal. Variants are equality-joined and every
candidate pair is verified by its whole bit distance.

Only distinct fingerprints are indexed, so a group of any number of equal texts is one entry. The join makes every pair of
fingerprints that share a variant, then verifies it. A variant of over ``hot`` fingerprints (a segment that many share) isn't
paired: its members are told apart by the same method on the bits that the variant leaves open, and again, until groups are small
or 8 bits are open.

Spark sizes an index by the fingerprints that it was exploded from, tens of times too low, so the index's self joins are sort-merge
joins by a hint: none of its sides may be broadcast for its estimate.

Defined results: a null text counts as empty; a text without words has fingerprint zero and links like any other;
repeated rows are one row each in the result; a null id stays a row, and is never the smallest id of a group unless
all ids in it are null; empty input gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geofleet.llm.common import components, cut, for_workers, row_struct, salted_lookup

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Fingerprints of one variant that are paired as they are, and open bits below which any number is.
HOT = 64
LAST_BITS = 8


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED, chunk: int = 8192) -> int:
    """64-bit SimHash of a text: a bit is 1 if set in over half the shingles' hashes; unsigned.

    The words are joined by single spaces in UTF-8; a shingle is then a slice of these bytes.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII only, in both
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - words + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, chunk):  # bounded memory for long texts
        to = min(n, at + chunk)
        last = np.minimum(np.arange(at, to) + words - 1, len(parts) - 1)
        hashes = np.array([digest(joined[s:e], seed) for s, e in zip(starts[at:to].tolist(), ends[last].tolist(), strict=True)], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, key, fp): a digest of every row's whole text and its fingerprint, as a signed 64-bit integer."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fps = np.array([fingerprint(t if isinstance(t, str) else None, words) for t in frame["text"]], "u8").astype("i8")
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "key": frame["key"], "fp": fps})

    narrow = for_workers(df).select(F.col(id_col).cast("long").alias("doc_id"), _text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    return narrow.mapInPandas(run, "doc_id long, key binary, fp long")


def _text_key(text_col: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _segments(max_bits: int) -> list[tuple[int, int, bool]]:
    """(shift, width, with wildcards) of each segment."""
    n = max_bits // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(cuts[i], cuts[i + 1] - cuts[i], max_bits % 2 == 1 or i < n - 1) for i in range(n)]


def _segment(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit(_signed((1 << width) - 1)))


def _variants(fp: Column, max_bits: int) -> Column:
    """Keys (segment, deleted bit, rest) of a fingerprint's variants; deleted bit -1: the whole segment."""
    keys = []
    for n, (shift, width, wildcards) in enumerate(_segments(max_bits)):
        part = _segment(fp, shift, width)
        for bit in range(width) if wildcards else [-1]:
            rest = part if bit < 0 else part.bitwiseAND(F.lit(_signed(((1 << width) - 1) ^ (1 << bit))))
            keys.append(F.struct(F.lit(100 * n + bit).alias("slot"), rest.alias("rest")))
    return F.array(*keys)


def _first_found(a: Column, b: Column, slot: Column, max_bits: int) -> Column:
    """Whether a pair's join by ``slot`` is the first of its joins, so that each pair is made once.

    That is the first segment with one differing bit at most, by this bit, or by its bit 0 where none differs.
    """
    first = F.lit(None).cast("int")
    for n, (shift, width, wildcards) in reversed(list(enumerate(_segments(max_bits)))):
        diff = _segment(a.bitwiseXOR(b), shift, width)
        if wildcards:
            place = F.coalesce(F.bit_count(F.try_subtract(diff, F.lit(1))), F.lit(63))  # of the one bit that is set
            bit = F.when(diff == 0, 0).otherwise(place)
            first = F.when(F.bit_count(diff) <= 1, F.lit(100 * n) + bit).otherwise(first)
        else:
            first = F.when(diff == 0, F.lit(100 * n - 1)).otherwise(first)
    return slot == first


def _near(max_bits: int) -> Column:
    return F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits


def _one(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def _wildcard_keys(segment: int, mask: Column, bits: Column) -> Column:
    def key(bit: Column) -> Column:
        kept = F.when(bit < 0, F.lit(-1).cast("long")).otherwise(F.bitwise_not(_one(bit)))
        rest = F.col("fp").bitwiseAND(mask).bitwiseAND(kept)
        return F.struct(F.xxhash64("path", F.lit(segment), bit, rest).alias("path"), F.col("open").bitwiseAND(F.bitwise_not(mask)).alias("open"))

    return F.transform(bits, key)


def _open_variants(max_bits: int) -> tuple[Column, Column]:
    """Keys (path with the variant, bits that it leaves open) of a member (fp, path, open), over its open bits in segments of about equal size,
    and the places of these bits, a column ``bits``."""
    parts = max_bits // 2 + 1
    bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.col("open").bitwiseAND(_one(b)) != 0)
    keys = []
    for n in range(parts):
        at = lambda i: F.floor(F.size("bits") * i / parts).cast("int")
        own = F.slice("bits", at(n) + 1, at(n + 1) - at(n))
        mask = F.aggregate(own, F.lit(0).cast("long"), lambda m, b: m.bitwiseOR(_one(b)))
        wildcards = own if max_bits % 2 == 1 or n < parts - 1 else F.array(F.lit(-1))
        keys.append(_wildcard_keys(n, mask, wildcards))
    return F.concat(*keys), bits


def _links_within(members: DataFrame, max_bits: int, hot: int) -> list[DataFrame]:
    """Links between members (fp, path, open) of the same path; ``open`` has the bits that the path leaves open."""
    found = []
    while True:
        keys, bits = _open_variants(max_bits)
        done = F.bit_count("open") <= LAST_BITS
        index = cut(members.where(~done).withColumn("bits", bits).select("fp", F.explode(keys).alias("k")).select("fp", "k.path", "k.open")
                    .union(members.where(done).select("fp", "path", F.lit(0).cast("long").alias("open"))))
        large = cut(index.where("open <> 0").groupBy("path").count().where(F.col("count") > hot).select("path"))
        cold = index.join(large, "path", "left_anti")
        a, b = cold.select(F.col("fp").alias("u"), "path"), cold.select(F.col("fp").alias("v"), "path")
        found.append(a.hint("merge").join(b, "path").where((F.col("u") < F.col("v")) & _near(max_bits)).select("u", "v").distinct())
        if large.isEmpty():
            return found
        members = index.join(large, "path", "left_semi")


def links(fps: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT) -> DataFrame:
    """(u, v): every pair of different fingerprints at ``max_bits`` or fewer differing bits, once, u < v.

    ``fps`` has distinct values in ``fp``.
    """
    index = fps.select("fp", F.explode(_variants(F.col("fp"), max_bits)).alias("k")).select("fp", "k.slot", "k.rest")
    large = cut(index.groupBy("slot", "rest").count().where(F.col("count") > hot).select("slot", "rest"))
    many = not large.isEmpty()
    cold = index.join(large, ["slot", "rest"], "left_anti") if many else index
    a, b = cold.withColumnRenamed("fp", "u"), cold.withColumnRenamed("fp", "v")
    pairs = (a.hint("merge").join(b, (a["slot"] == b["slot"]) & (a["rest"] == b["rest"]) & (F.col("u") < F.col("v")) & _near(max_bits)
                    & _first_found(F.col("u"), F.col("v"), a["slot"], max_bits))
             .select("u", "v"))
    if not many:
        return pairs
    whole = (1 << 64) - 1
    rest_of = F.array(*[F.lit(_signed(whole & ~(((1 << width) - 1) << shift))) for shift, width, _ in _segments(max_bits)])
    members = index.join(large, ["slot", "rest"], "left_semi").select(
        "fp", F.xxhash64("slot", "rest").alias("path"), F.get(rest_of, F.floor((F.col("slot") + 1) / 100).cast("int")).alias("open"))
    for more in _links_within(members, max_bits, hot):
        pairs = pairs.union(more)
    return pairs.distinct()


def _labelled(df: DataFrame, id_col: str, text_col: str, words: int, max_bits: int) -> DataFrame:
    """One row per document: doc_id, key, fp, label (of the group), component_id (its smallest id)."""
    fps = cut(fingerprints(df, id_col, text_col, words))
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    labels = components(links(classes.select("fp"), max_bits))
    joined = classes.join(labels, classes["fp"] == labels["node"], "left").select(
        classes["fp"], "least", F.coalesce("label", "fp").alias("label"))
    smallest = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    groups = salted_lookup(joined, smallest, "label", "fp").select("fp", "label", "component_id")
    return salted_lookup(fps, groups, "fp", "doc_id").select("doc_id", "key", "fp", "label", "component_id")


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                   max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fp (signed long), fingerprint (16 hex digits), component_id."""
    return _labelled(df, id_col, text_col, words, max_bits).select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                     max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``df`` for each group, of its smallest id; all its columns. Rows without an id stay.

    Rows that repeat an id and the whole text are one document: one of them stays. Of a smallest id with several texts in
    its group, the text of the least digest stays. An id with texts in several groups is judged in each by itself.
    """
    found = cut(_labelled(df, id_col, text_col, words, max_bits))
    tied = found.where("doc_id = component_id").select("label", "doc_id", "key").distinct()
    one = tied.groupBy("label").agg(F.min("key").alias("_least"))
    gone = (found.where("doc_id <> component_id").select("doc_id", "key")
            .union(tied.join(one, "label").where("key <> _least").select("doc_id", "key")).distinct().toDF("_gone", "_gone_key"))
    packed = df.select(row_struct(df).alias("row"), F.col(id_col).cast("long").alias("_id"), _text_key(text_col).alias("_key"))
    kept = packed.join(gone, (packed["_id"] == gone["_gone"]) & (packed["_key"] == gone["_gone_key"]), "left_anti")
    apart = kept.withColumn("_row", F.when(F.col("_id").isNull(), F.monotonically_increasing_id()))
    return apart.dropDuplicates(["_id", "_key", "_row"]).select("row.*")

"""Operator 11: a trie of conversations by fixed-length block hashing.

A node is a distinct sequence of a conversation's first d turns; conversations that start with it are its members.

1. Turns are numbered in their order by a range sort, so no conversation is gathered in one task.
2. Every turn at place d is hashed with its place to 128 bits; a prefix is known by its length and the exclusive or of its turns'
   hashes, which running sums give without a chain of digests. ``block`` consecutive turns make a block, and conversations are
   grouped by successive blocks: (prefix before, block). All later work is on distinct blocks with their counts.
3. Below a prefix with one block only, all members share every turn of it: its turns are nodes as they are. Where sibling blocks
   diverge (or a conversation ends inside the block), and only there, blocks are cut into turns and grouped again.
4. A node's smallest member owns it. An owner's nodes are one path down to its end, hung on a node of a smaller owner, so
   subtree sums are taken over the much smaller tree of owners, by doubling (log2 of its height rounds), and then along each
   path by running sums.

Running sums go by (conversation, chunk of places), with the sums of whole chunks added: no task holds a conversation or a
path as a whole. The ends' digest is one hash over sorted ids, fed in batches of bounded size.

Defined results: null role or text counts as empty; turns go by turn, null first, ties by a digest of role and text; repeated
turns are turns each; rows without a conversation id are no conversation; no conversations give no rows, not even the root; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geofleet.llm.common import cut, for_workers, salted_lookup

BLOCK = 4
CHUNK = 4096
BASE_EVERY = 100
SHARED_TURNS = 6
MAX_ROUNDS = 64


def number_turns(df: DataFrame, conv_col: str = "conv_id", order_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, at, digest, length) of every turn: its place from 0, a digest of role and text, and the text's code points. Stored."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = df.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(order_col).alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("length"))
    keys = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest")]
    placed = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "conv", "digest", "length", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")))
    parts = placed.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.select("conv", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return cut(placed.join(shift, ["conv", "part"]).select("conv", (F.col("row") + F.col("shift")).alias("at"), "digest", "length"))


def conversations(turns: DataFrame) -> DataFrame:
    """(conv, n) of numbered turns."""
    return turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))


def graft(turns: DataFrame, every: int = BASE_EVERY, shared: int = SHARED_TURNS) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt as branches: the first h turns of conversation c - c % every, then c's own after its first h; h = crc32(c) % shared.

    (turns, conversations) as ``number_turns`` and ``conversations`` give them; a conversation may be left without turns.
    """
    conv = F.col("conv")
    heads = (turns.where((conv % every == 0) & (F.col("at") < shared - 1)).groupBy(conv.alias("base"))
             .agg(F.array_sort(F.collect_list(F.struct("at", "digest", "length"))).alias("head")))
    h = (F.crc32(conv.cast("string").cast("binary")) % shared).cast("int")
    planned = conversations(turns).withColumn("h", h).withColumn("base", conv - conv % every).join(heads, "base", "left")
    plan = cut(planned.select("conv", "n", "h", F.coalesce(F.slice("head", 1, F.col("h")), F.array().cast(heads.schema["head"].dataType)).alias("head")))
    own = salted_lookup(turns, plan.select("conv", "h", F.size("head").alias("given")), "conv", "at").where("at >= h")
    rebuilt = own.select("conv", (F.col("at") - F.col("h") + F.col("given")).alias("at"), "digest", "length").unionByName(
        plan.select("conv", F.explode("head").alias("t")).select("conv", "t.at", "t.digest", "t.length"))
    return rebuilt, plan.select("conv", (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))


def _before(rows: DataFrame, key: str, place: str, chunk: int, sums: dict[str, Column], down: bool = False, inclusive: bool = False) -> DataFrame:
    """``rows`` with the running aggregates ``sums`` over earlier places (later ones where ``down``) of the same key.

    ``rows`` has a row for every place from 0 up to a key's last. Each chunk of places is summed by itself; sums of whole
    chunks, a row per ``chunk`` rows, are carried over to the others. Aggregates are ``bit_xor`` (up) or ``sum`` (down).
    """
    cut_rows = rows if "_chunk" in rows.columns else rows.withColumn("_chunk", F.floor(F.col(place) / chunk))
    order = F.col(place).desc() if down else F.col(place)
    inside = Window.partitionBy(key, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local = cut_rows.select("*", *[F.coalesce(c.over(inside), F.lit(0)).alias(f"_in_{name}") for name, c in sums.items()])
    totals = local.groupBy(key, "_chunk").agg(F.count(F.lit(1)).alias("_rows"), *[c.alias(f"_t_{name}") for name, c in sums.items()])
    many = totals.where(F.col("_chunk") > 0 if down else F.col("_rows") == chunk)  # chunks that another one builds on
    across = Window.partitionBy(key).orderBy(F.col("_chunk").desc() if down else F.col("_chunk")).rowsBetween(Window.unboundedPreceding, 0)
    again = {name: F.sum(f"_t_{name}") if down else F.bit_xor(f"_t_{name}") for name in sums}
    carried = many.select(key, (F.col("_chunk") + (-1 if down else 1)).alias("_chunk"), *[c.over(across).alias(f"_c_{name}") for name, c in again.items()])
    both = local.join(carried, [key, "_chunk"], "left")
    merge = (lambda a, b: a + b) if down else (lambda a, b: a.bitwiseXOR(b))
    done = [merge(F.col(f"_in_{name}"), F.coalesce(F.col(f"_c_{name}"), F.lit(0))).alias(name) for name in sums]
    return both.select(*[c for c in rows.columns if c != "_chunk"], *done)


def _key(depth: Column, a: Column, b: Column) -> Column:
    return F.struct(depth.cast("long").alias("d"), a.alias("a"), b.alias("b"))


def _blocks(turns: DataFrame, block: int, chunk: int) -> DataFrame:
    """(conv, number, k1, k2, turns array<struct<at, f1, f2, length>>): every block of every conversation with the prefix before it."""
    hashed = turns.select("conv", "at", "length", F.xxhash64(F.lit(1), "at", "digest").alias("f1"), F.xxhash64(F.lit(2), "at", "digest").alias("f2"))
    # One exchange for the grouping and the running sums: both are clustered by (conv, chunk).
    dealt = hashed.withColumn("number", F.floor(F.col("at") / block)).withColumn("_chunk", F.floor(F.col("number") / chunk)).repartition("conv", "_chunk")
    grouped = dealt.groupBy("conv", "_chunk", "number").agg(
        F.array_sort(F.collect_list(F.struct("at", "f1", "f2", "length"))).alias("turns"), F.bit_xor("f1").alias("x1"), F.bit_xor("f2").alias("x2"))
    return _before(grouped, "conv", "number", chunk, {"k1": F.bit_xor("x1"), "k2": F.bit_xor("x2")})


def _turn_nodes(blocks: DataFrame) -> DataFrame:
    """One row per turn of each distinct block: key, parent, length, n_convs, conv."""
    def prefix(which: str, upto: Column) -> Column:
        return F.aggregate(F.slice("turns", 1, upto), F.col(f"k{which}"), lambda s, t: s.bitwiseXOR(t[f"f{which}"]))

    cells = F.transform("turns", lambda t, i: F.struct(
        _key(t["at"] + 1, prefix("1", i + 1), prefix("2", i + 1)).alias("key"), _key(t["at"], prefix("1", i), prefix("2", i)).alias("parent"),
        t["length"].alias("length")))
    return blocks.select(F.explode(cells).alias("c"), "n_convs", "conv").select("c.key", "c.parent", "c.length", "n_convs", "conv")


def _nodes(blocks: DataFrame) -> DataFrame:
    """(key, parent, length, n_convs, conv) of all nodes but the root."""
    size = F.size("turns")
    before = _key(F.element_at("turns", 1)["at"], F.col("k1"), F.col("k2"))
    after = _key(F.element_at("turns", -1)["at"] + 1, F.col("k1").bitwiseXOR(F.col("x1")), F.col("k2").bitwiseXOR(F.col("x2")))
    distinct = cut(blocks.groupBy(before.alias("before"), after.alias("after")).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv"), F.first("turns").alias("turns"), F.first("k1").alias("k1"), F.first("k2").alias("k2")))
    siblings = distinct.groupBy("before").agg(F.count(F.lit(1)).alias("n"))
    counted = salted_lookup(distinct.withColumn("size", size), siblings, "before", "after")
    alone = _turn_nodes(counted.where("n = 1"))
    refined = _turn_nodes(counted.where("n > 1")).groupBy("key").agg(
        F.first("parent").alias("parent"), F.first("length").alias("length"), F.sum("n_convs").alias("n_convs"), F.min("conv").alias("conv"))
    return alone.unionByName(refined)


def _subtree(tree: DataFrame, names: list[str]) -> DataFrame:
    """(conv, names) summed over each conversation's subtree; ``tree`` is (conv, up, names), ``up`` null at the root.

    Before round r, ``names`` hold the sums over descendants less than 2**r steps down and ``up`` the ancestor 2**r steps up.
    """
    at = cut(tree)
    for _ in range(MAX_ROUNDS):
        climbing = at.where("up is not null")
        if climbing.isEmpty():
            return at.select("conv", *names)
        given = climbing.groupBy(F.col("up").alias("conv")).agg(*[F.sum(c).alias(f"_{c}") for c in names])
        further = salted_lookup(climbing.select("conv", "up"), at.select(F.col("conv").alias("up"), F.col("up").alias("next")), "up", "conv")
        at = cut(at.drop("up").join(given, "conv", "left").join(further.select("conv", F.col("next").alias("up")), "conv", "left").select(
            "conv", "up", *[(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in names]))
    raise RuntimeError("prefix_trie: paths are left after the last round")


def _ends(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) from (key, conv): a digest of each key's ids in ascending order, over sorted batches."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, digest = None, hashlib.sha256()
        for frame in frames:
            keys, values = frame["k"].tolist(), frame["conv"].tolist()
            done: list[tuple[str, str]] = []
            for k, v in zip(keys, values, strict=True):
                if k == key:
                    digest.update(b",%d" % v)
                    continue
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(b"%d" % v)
            yield pd.DataFrame(done, columns=["k", "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(key, digest.hexdigest())], columns=["k", "ends_sha256"])

    named = for_workers(ends).select(F.concat_ws(":", "key.d", "key.a", "key.b").alias("k"), "conv")
    return named.repartition("k").sortWithinPartitions("k", "conv").mapInPandas(run, "k string, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """The nodes of numbered turns (conv, at, digest, length) and conversations (conv, n): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs = cut(convs)
    blocks = cut(_blocks(turns, block, chunk))
    root_key = _key(F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long"))
    root = (convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv")).where("n_convs > 0").select(
        root_key.alias("key"), F.lit(None).cast("struct<d:bigint,a:bigint,b:bigint>").alias("parent"), F.lit(0).cast("long").alias("length"), "n_convs", "conv"))
    nodes = cut(_nodes(blocks).unionByName(root))

    last = blocks.select("conv", (F.element_at("turns", -1)["at"] + 1).alias("d"), F.col("k1").bitwiseXOR(F.col("x1")).alias("a"), F.col("k2").bitwiseXOR(F.col("x2")).alias("b"))
    ended = last.groupBy("conv").agg(F.max_by(_key(F.col("d"), F.col("a"), F.col("b")), "d").alias("key"))
    ends = _ends(ended.select("key", "conv").unionByName(convs.where("n = 0").select(root_key.alias("key"), "conv")))

    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv"))
    joined = salted_lookup(nodes, above, "parent", "key").join(children, "key", "left").withColumn("k", F.concat_ws(":", "key.d", "key.a", "key.b"))
    known = cut(joined.join(ends, "k", "left").select(
        F.col("key.d").alias("depth"), "conv", "parent_conv", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        ((F.col("n_convs") - 1) * F.col("length")).alias("saved"), F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaf")))

    # The tree of owners: each hangs on the node above its topmost one.
    top = known.groupBy("conv").agg(F.min("depth").alias("top"), F.min_by("parent_conv", "depth").alias("up"), F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    owners = cut(top)
    below = _subtree(owners.select("conv", "up", "saved", "leaf"), ["saved", "leaf"])
    hung = (owners.select("conv", "up", "top").where("up is not null").join(below, "conv")
            .groupBy(F.col("up").alias("conv"), (F.col("top") - 1).alias("depth")).agg(F.sum("saved").alias("_saved"), F.sum("leaf").alias("_leaf")))
    valued = known.join(hung, ["conv", "depth"], "left").withColumn("v", F.col("saved") + F.coalesce("_saved", F.lit(0))).withColumn(
        "l", F.col("leaf") + F.coalesce("_leaf", F.lit(0))).drop("saved", "leaf", "_saved", "_leaf")
    summed = _before(valued, "conv", "depth", chunk, {"saved_tokens": F.sum("v"), "n_leaves": F.sum("l")}, down=True, inclusive=True)
    return summed.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                         "saved_tokens", "ends_sha256")


def prefix_trie(df: DataFrame, conv_col: str = "conv_id", order_col: str = "turn", role_col: str = "role", text_col: str = "text",
                block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """The trie of a table of turns as it is: one row per distinct prefix (see ``trie``)."""
    turns = number_turns(df, conv_col, order_col, role_col, text_col)
    return trie(turns, conversations(turns), block, chunk)

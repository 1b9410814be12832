"""Operator 1: mixing sources to target weights by Pfair scheduling. DataFrame functions only.

The rows of each source, in an order drawn by hash, are cut into blocks of ``block_rows``. One block takes one slot of
the mix. A source of weight a and b blocks is due min(b, a v) of them at virtual time v, and slot t is where all dues add up to
t: each source gets its share of the weights, and of the weights that are left when others have run out. Its block k (from 0) is
released at floor(t(k / a)), has its deadline at ceil(t((k + 1) / a)), and each slot goes to the released block of the
earliest deadline. Every deadline is met, no slot stays empty, and after any number of slots a source has had less than one block more or
less than its due. Weights are whole multiples of the largest one's 10^-9th part (at least one), and t is computed exactly.

The schedule is made in stretches of deadlines, all at once. Earliest deadline first gives each block, in the order of deadlines, the
first free slot from its release on. So a stretch needs to know the free slots that the blocks before it leave. Let r be the first
release among blocks of this stretch or later ones: slots before r are taken, those blocks released before r take the slots up to their
number, and the others lie in the stretch before, as a stretch is at least as long as the longest window. A task
gets two stretches of blocks, whatever the size of the data.

A source may hold most rows: its rows are numbered in hash buckets of about ``bucket_rows`` rows, offset by the buckets'
counts. The rows move in one shuffle by (source, bucket).

Defined results: a null source is a source of its own; a source without a positive, finite weight gets ``stray`` of
the sum of the others' weights (or 1 if there is none); every row is kept, null ids, repeated rows and empty texts included; extra columns stay, and
a result column replaces an input column of its name; empty input gives no rows; any number of sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType
from pyspark.sql.window import Window

from geofleet.llm.common import cut, quoted, row_struct, salted_lookup

BLOCK_ROWS = 64
BUCKET_ROWS = 2048
SMOOTHING = 0.5
STRAY = 0.001
#: Weights are whole numbers up to this.
RESOLUTION = 10**9
#: Least number of slots in a stretch, and of blocks in one part of its fold.
STRETCH = 4096
FOLD = 256
#: Sources of more bytes are looked up by a shuffle.
BROADCAST_BYTES = 8 << 20


def source_key(source: Column) -> Column:
    """The source as a text, null distinct from every other."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source.cast("string")))


def smoothed_weights(df: DataFrame, source_col: str = "source", exponent: float = SMOOTHING) -> DataFrame:
    """(source, weight): target weights as the sources' row counts to a power, so small sources gain."""
    return df.groupBy(F.col(source_col).alias("source")).agg(F.pow(F.count(F.lit(1)).cast("double"), F.lit(exponent)).alias("weight"))


def _sources(keyed: DataFrame, weights: DataFrame, block_rows: int, stray: float) -> DataFrame:
    """One row per source: key, a (its weight as a whole number), blocks, rows."""
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    weight = F.col("weight").cast("double")
    sane = F.when((weight > 0) & (weight < float("inf")), weight)
    given = weights.groupBy(source_key(F.col("source")).alias("key")).agg(F.max(sane).alias("w"))
    everything = Window.partitionBy(F.lit(1))  # over a row per source
    filled = (counts.join(given, "key", "left").withColumn("top", F.max("w").over(everything))
              .withColumn("u", F.col("w") / F.col("top"))
              .withColumn("u", F.coalesce("u", stray * F.sum("u").over(everything), F.lit(1.0)))
              .withColumn("u", F.col("u") / F.max("u").over(everything)))
    return filled.select("key", F.greatest(F.lit(1), F.round(F.col("u") * RESOLUTION)).cast("long").alias("a"), "rows",
                         F.ceil(F.col("rows") / block_rows).alias("blocks"))


def pfair_windows(ranges: DataFrame, sources: DataFrame) -> DataFrame:
    """(key, block, release, deadline) of the blocks of ``ranges(key, lo, hi)``, from all ``sources(key, a, blocks)``.

    t(k / a) = sum over sources of min(blocks, their a * k / a). Within a range, sources that have run out by its start add
    their blocks and those that last beyond its end add their a; only the others are asked for each block.
    """
    exact = lambda c: c.cast("decimal(38,0)")
    every = sources.agg(F.collect_list(F.struct("a", "blocks")).alias("s")).scalar()
    done = lambda x: x["blocks"] * F.col("a") <= x["a"] * F.col("lo")
    lasts = lambda x: x["blocks"] * F.col("a") >= x["a"] * (F.col("hi") + 1)
    zero = F.lit(0).cast("long")
    split = (ranges.join(sources.select("key", "a"), "key").withColumn("s", every)
             .select("key", "a", "lo", "hi",
                     F.aggregate(F.filter("s", done), zero, lambda t, x: t + x["blocks"]).alias("gone"),
                     F.aggregate(F.filter("s", lambda x: ~done(x) & lasts(x)), zero, lambda t, x: t + x["a"]).alias("rate"),
                     F.filter("s", lambda x: ~done(x) & ~lasts(x)).alias("ending")))

    def times_a(k: Column) -> Column:
        return F.aggregate("ending", exact(exact(F.col("gone")) * F.col("a") + exact(F.col("rate")) * k),
                           lambda t, x: exact(t + F.least(x["blocks"] * F.col("a"), x["a"] * k)))

    blocks = split.select("*", F.explode(F.sequence("lo", "hi")).alias("block"))
    return (blocks.select("key", "block", exact(F.col("a")).alias("a"), times_a(F.col("block")).alias("from"), times_a(F.col("block") + 1).alias("to"))
            .selectExpr("key", "block", "`from` div a as release", "(`to` + a - 1) div a as deadline"))


def _first_free_slots(jobs: Column, taken: Column) -> Column:
    """jobs array<struct(own, deadline, key, block, release)> -> the own jobs with ``mix_slot``: the first free slot from the release on.

    Slots before ``taken`` are taken. The fold's state is the end of the taken slots and the holes before it. It runs in
    parts, so that no long array is copied for each job.
    """
    placed = "array<struct<key:string,block:bigint,release:bigint,deadline:bigint,mix_slot:bigint>>"

    def state_of(end: Column, holes: Column, out: Column) -> Column:
        return F.struct(end.alias("end"), holes.alias("holes"), out.alias("out"))

    def step(state: Column, job: Column) -> Column:
        end, release = state["end"], job["release"]
        hole = F.array_min(F.filter(state["holes"], lambda h: h >= release))

        def place(slot: Column) -> Column:
            holes = (F.when(slot < end, F.array_remove(state["holes"], slot))
                     .when(slot > end, F.concat(state["holes"], F.sequence(end, slot - 1))).otherwise(state["holes"]))
            mine = F.array(F.struct(job["key"].alias("key"), job["block"].alias("block"), release.alias("release"),
                                    job["deadline"].alias("deadline"), slot.alias("mix_slot")))
            return state_of(F.greatest(end, slot + 1), holes, F.when(job["own"], F.concat(state["out"], mine)).otherwise(state["out"]))

        return F.transform(F.array(F.coalesce(hole, F.greatest(end, release))), place)[0]

    def part(state: Column, some: Column) -> Column:
        fresh = state_of(state["end"], state["holes"], F.array().cast(placed))
        return F.transform(F.array(F.aggregate(some, fresh, step)),
                           lambda n: state_of(n["end"], n["holes"], F.concat(state["out"], F.array(n["out"]))))[0]

    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(jobs) - 1) / FOLD).cast("int")), lambda i: F.slice(jobs, i * FOLD + 1, FOLD))
    start = state_of(taken.cast("long"), F.array().cast("array<bigint>"), F.array().cast(f"array<{placed}>"))
    return F.flatten(F.aggregate(parts, start, part, lambda n: n["out"]))


def earliest_deadline_first(windows: DataFrame, stretch: int) -> DataFrame:
    """``windows(key, block, release, deadline)`` with their slot. ``stretch`` is at least the longest deadline - release.

    Ties go to the first key.
    """
    jobs = windows.withColumn("stretch", F.floor((F.col("deadline") - 1) / stretch))
    in_order = Window.partitionBy(F.lit(1)).orderBy("stretch")  # over a row per stretch
    starts = (jobs.groupBy("stretch").agg(F.count(F.lit(1)).alias("n"), F.min("release").alias("r"))
              .select("stretch", (F.sum("n").over(in_order) - F.col("n")).alias("before"),
                      F.min("r").over(in_order.rowsBetween(0, Window.unboundedFollowing)).alias("first_release")))
    twice = (jobs.withColumn("at", F.explode(F.array(F.col("stretch"), F.col("stretch") + 1)))
             .select(F.col("at").alias("stretch"), (F.col("at") == F.col("stretch")).alias("own"), "deadline", "key", "block", "release"))
    gathered = (twice.join(starts, "stretch").where(F.col("own") | (F.col("release") >= F.col("first_release")))
                .groupBy("stretch").agg(
                    (F.first("before") - F.count_if(~F.col("own"))).alias("taken"),
                    F.array_sort(F.collect_list(F.struct("own", "deadline", "key", "block", "release"))).alias("jobs")))
    return gathered.select(F.inline(_first_free_slots(F.col("jobs"), F.col("taken"))))


def pfair_schedule(ranges: DataFrame, sources: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """(key, block, release, deadline, mix_slot) of the blocks of ``ranges(key, lo, hi)``, all blocks of ``sources(key, a, blocks)``."""
    windows = cut(pfair_windows(ranges, sources))
    longest = windows.agg(F.max(F.col("deadline") - F.col("release"))).first()[0]
    return earliest_deadline_first(windows, max(stretch, longest or 0))


def mix(df: DataFrame, weights: DataFrame, source_col: str = "source", id_col: str = "doc_id", block_rows: int = BLOCK_ROWS,
        bucket_rows: int = BUCKET_ROWS, stray: float = STRAY, stretch: int = STRETCH) -> DataFrame:
    """``df`` with its place in the mix: source_block (from 0), release, deadline and mix_slot of this block, and
    mix_position = mix_slot * block_rows + place in the block: an order of all rows, with gaps only after sources' last blocks.

    ``weights`` has (source, weight).
    """
    hashable = [F.col(quoted(f.name)) for f in df.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    keyed = df.select(row_struct(df).alias("row"), source_key(F.col(source_col)).alias("key"),
                      F.xxhash64(F.col(id_col), F.col(source_col)).alias("h"), F.xxhash64(*hashable).alias("whole"))
    sources = cut(_sources(keyed.select("key"), weights, block_rows, stray))
    spread = sources.select("key", F.ceil(F.col("rows") / bucket_rows).alias("buckets"))
    size = sources.agg(F.sum(F.octet_length("key") + 64)).first()[0] or 0
    known = keyed.join(F.broadcast(spread), "key") if size <= BROADCAST_BYTES else salted_lookup(keyed, spread, "key", "h")
    dealt = known.withColumn("bucket", F.pmod(F.xxhash64("h", F.col("whole")), F.col("buckets")))

    # Buckets: their first row's number within the source, and the slots of the blocks that they reach into.
    counts = dealt.groupBy("key", "bucket").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.withColumn("first", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    reached = firsts.select("key", "bucket", "first", F.explode(F.sequence(
        F.floor(F.col("first") / block_rows), F.floor((F.col("first") + F.col("n") - 1) / block_rows))).alias("block"))
    starting = firsts.select("key", F.ceil(F.col("first") / block_rows).alias("lo"),
                             F.floor((F.col("first") + F.col("n") - 1) / block_rows).alias("hi")).where("lo <= hi")
    slotted = reached.join(pfair_schedule(starting, sources, stretch), ["key", "block"])
    places = slotted.groupBy("key", "bucket").agg(F.first("first").alias("first"), F.array_sort(F.collect_list(F.struct(
        "block", "mix_slot", "release", "deadline"))).alias("places"))

    order = Window.partitionBy("key", "bucket").orderBy("h", "whole")
    numbered = dealt.select("key", "bucket", "row", F.row_number().over(order).alias("n"))
    at = F.col("first") + F.col("n") - 1
    block = F.floor(at / block_rows)
    place = F.element_at("places", (block - F.col("places")[0]["block"] + 1).cast("int"))
    made = numbered.join(places, ["key", "bucket"]).select("row", at.alias("at"), place.alias("p"))
    new = {"source_block": F.col("p.block"), "release": F.col("p.release"), "deadline": F.col("p.deadline"), "mix_slot": F.col("p.mix_slot"),
           "mix_position": F.col("p.mix_slot") * block_rows + F.col("at") % block_rows}
    old = [F.col(f"row.{quoted(c)}").alias(c) for c in df.columns if c not in new]
    return made.select(*old, *[v.alias(k) for k, v in new.items()])


def in_mixed_order(df: DataFrame, weights: DataFrame, files: int | None = None, **options) -> DataFrame:
    """The rows and columns of ``df`` in the order of the mix: range-partitioned and sorted by mix_position."""
    mixed = mix(df, weights, **options)
    ranged = mixed.repartitionByRange(files, "mix_position") if files else mixed.repartitionByRange("mix_position")
    return ranged.sortWithinPartitions("mix_position").select(*[quoted(c) for c in df.columns])

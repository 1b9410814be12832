"""Operator 9: embedding near-duplicates by dual traversal of cover trees, exact.

Unit vectors with cosine >= c lie within distance t = sqrt(2 - 2 c). Equal vectors are one entry with a count. The top of
the tree is global: up to ``most_pivots`` pivots (a net of a bounded sample), each entry in the cell of its nearest pivot where that is within
``CELL_RADIUS``, with the radius that covers the cell's entries. Entries far from all pivots are the rest. Cells are gathered into
blocks of about ``block_rows`` entries, large cells and the rest cut into several, so no cell is one task's. Each block builds its own tree of
nested nets with halving radii, every node with the exact radius that covers its descendants.

Two nodes are pruned when their centres are further apart than t and both radii; first cells against cells (the rest is compared with all), then, for each
pair of blocks with a pair of cells left, level by level down to entries, whose cosines are computed in double precision. A pair of blocks gives for each of
its vectors the number of links and one leader of its group there, so groups of thousands of near copies make no list of pairs.
Leaders are the edges of the components.

Vectors without structure (all about equally far apart) can't be pruned by any metric tree; then every pair of blocks is compared. So that this takes
time but not disk, consecutive blocks form sides, a task compares all pairs of two sides (a tile), and tiles are shuffled in rounds: a round holds
about two copies of each block, and its shuffle files go before the next one. Vectors are stored once at a time (rows, entries, placed entries, trees;
each goes when the next is there); what is joined to rows later is an entry's number.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing and are their own component;
so do vectors of different lengths with each other; equal vectors link, repeated rows included; a null id stays a row, and is never the smallest id
of a group unless all its ids are null; the label and other columns are ignored; empty input gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geofleet.llm.common import components, cut, drop_cut, for_workers, salted_lookup, shuffles_freed
from geofleet.session import scratch_path

COSINE = 0.9
BLOCK_ROWS = 2048
SAMPLE = 8192
PIVOTS = 2048
CELL_RADIUS = 0.5
RADII = (1.0, 0.5, 0.25)
#: Components of vectors on one side of a tile, and in the copies of a round where twice all blocks are fewer.
SIDE_VALUES = 1 << 20
ROUND_VALUES = 1 << 25
#: Distances for pruning are computed in single precision.
SLACK = 1e-3


def unit(rows: list | np.ndarray) -> np.ndarray:
    x = np.array(rows, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # else squares may overflow, or vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a.astype(np.float32, copy=False) @ b.astype(np.float32, copy=False).T), 0))


def pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """Centres of a farthest-first net: until all of the sample is within 0.25 of one, or there are ``most``."""
    sample = sample.astype(np.float32)
    centres = [0]
    least = distances(sample, sample[:1])[:, 0]
    while len(centres) < most and least.max() > 0.25:
        centres.append(int(least.argmax()))
        least = np.minimum(least, distances(sample, sample[centres[-1:]])[:, 0])
    return sample[centres]


class CoverTree:
    """levels: [(centres, parents, radii)] from the root to the entries. parents[i] is a place in the level above."""

    def __init__(self, x: np.ndarray, radii: tuple[float, ...] = RADII):
        d = distances(x, x)
        chosen, owner = [0], np.zeros(len(x), np.int64)
        nearest = d[0].copy()
        nets = [(np.array([0]), np.zeros(1, np.int64))]
        for r in radii:
            above = nets[-1][0]
            while (far := int(nearest.argmax())) is not None and nearest[far] > r:
                closer = d[far] < nearest
                owner[closer] = len(chosen)
                nearest[closer] = d[far][closer]
                chosen.append(far)
            # nested: the centres above come first here too, each its own parent
            parents = np.arange(len(chosen))
            new = np.array(chosen[len(above):], np.int64)
            parents[len(above):] = d[np.ix_(new, above)].argmin(axis=1) if len(new) else 0
            nets.append((np.array(chosen), parents))
        nets.append((np.arange(len(x)), owner))
        self.levels = []
        for depth, (centres, parents) in enumerate(nets):
            under = np.arange(len(x))  # the node here that each entry descends from
            for _, up in reversed(nets[depth + 1:]):
                under = up[under]
            reach = np.zeros(len(centres), np.float32)
            np.maximum.at(reach, under, d[centres[under], np.arange(len(x))])
            self.levels.append((centres, parents, reach if depth < len(nets) - 1 else np.zeros(len(x), np.float32)))


def _children(parents: np.ndarray, above: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each node of the level above: its children are order[first:first + count]."""
    order = np.argsort(parents, kind="stable")
    count = np.bincount(parents, minlength=above)
    return order, np.cumsum(count) - count, count


def _expanded(pa: np.ndarray, pb: np.ndarray, ka: tuple, kb: tuple) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children of the pairs of nodes (pa, pb)."""
    many = ka[2][pa] * kb[2][pb]
    pair = np.repeat(np.arange(len(pa)), many)
    place = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)
    wide = kb[2][pb][pair]
    return ka[0][ka[1][pa][pair] + place // wide], kb[0][kb[1][pb][pair] + place % wide]


def dual_traversal(a: CoverTree, b: CoverTree, xa: np.ndarray, xb: np.ndarray, t: float, dense: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of entries (of a, of b) that can't be pruned.

    Level by level, the children of the pairs left are tested. Where these are more than a ``dense`` share of all
    pairs of the level, the level's pairs are tested by one matrix product instead: that tests more, and so prunes no link.
    """
    fa, fb = xa.astype(np.float32), xb.astype(np.float32)
    t, chunk = np.float32(t + SLACK), 1 << 18
    pa = pb = np.zeros(1, np.int64)
    above = None
    for (ca, ua, ra), (cb, ub, rb) in zip(a.levels, b.levels, strict=True):
        if above:
            ka, kb = _children(ua, above[0]), _children(ub, above[1])
            size = int((ka[2][pa] * kb[2][pb]).sum())
        else:
            size = 1
        if size > max(1024, dense * len(ca) * len(cb)):
            # d <= t + ra + rb, by the cosine: cos >= 1 - (t + ra + rb)^2 / 2, so cos + p q + p^2 / 2 + q^2 / 2 - 1 >= 0
            p, q, ones = ra + t / 2, rb + t / 2, np.ones(max(len(ca), len(cb)), np.float32)
            room = np.column_stack([fa[ca], p, (p * p - 1) / 2, ones[:len(ca)]]) @ np.column_stack([fb[cb], q, ones[:len(cb)], (q * q - 1) / 2]).T
            pa, pb = np.divmod(np.flatnonzero(room >= 0), len(cb))
        else:
            if above:
                pa, pb = _expanded(pa, pb, ka, kb)
            left = [np.flatnonzero(np.einsum("ij,ij->i", fa[ca[pa[k:k + chunk]]], fb[cb[pb[k:k + chunk]]])
                                   >= 1 - 0.5 * (t + ra[pa[k:k + chunk]] + rb[pb[k:k + chunk]]) ** 2) + k for k in range(0, len(pa), chunk)]
            left = np.concatenate(left) if left else np.zeros(0, np.int64)
            pa, pb = pa[left], pb[left]
        above = len(ca), len(cb)
    return pa, pb


def groups(linked: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers of the rows and the columns of a matrix of links; ``same``: these are the same entries."""
    rows, cols = linked.shape
    la = np.arange(rows)
    lb = la.copy() if same else np.full(cols, rows)
    while True:
        nb = np.minimum(lb, np.where(linked, la[:, None], rows).min(axis=0, initial=rows))
        na = np.minimum(la, np.where(linked, nb[None, :], rows).min(axis=1, initial=rows))
        if same:
            na = nb = np.minimum(na, nb)
        if (na == la).all() and (nb == lb).all():
            return la, lb
        la, lb = na, nb


def links_between(a: dict, b: dict, cosine: float, same: bool) -> pd.DataFrame:
    """Of the entries of two blocks that link: entry, links (weighted by copies), leader (an entry it is connected with)."""
    xa, xb = a["unit"], b["unit"]
    ia, ib = dual_traversal(a["tree"], b["tree"], xa, xb, np.sqrt(max(0.0, 2 - 2 * cosine)))
    if same:
        ia, ib = ia[ia != ib], ib[ia != ib]
    ra, rb = np.unique(ia), np.unique(ib)
    linked = np.zeros((len(ra), len(rb)), bool)
    at = np.searchsorted(ra, ia), np.searchsorted(rb, ib)
    linked[at] = (xa[ra] @ xb[rb].T)[at] >= cosine
    if same:  # rounding may differ on the two sides of the diagonal
        ra = rb = np.union1d(ra, rb)
        full = np.zeros((len(ra), len(ra)), bool)
        full[np.ix_(np.searchsorted(ra, np.unique(ia)), np.searchsorted(ra, np.unique(ib)))] = linked
        linked = full | full.T
    rows, cols = linked.any(axis=1), linked.any(axis=0)
    ra, rb, linked = ra[rows], rb[cols], linked[rows][:, cols]
    la, lb = groups(linked, same)
    out = [pd.DataFrame({"entry": a["entry"][ra], "links": linked @ b["copies"][rb], "leader": a["entry"][ra][la]})]
    if not same:
        out.append(pd.DataFrame({"entry": b["entry"][rb], "links": a["copies"][ra] @ linked, "leader": a["entry"][ra][lb]}))
    return pd.concat(out, ignore_index=True)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE,
                    block_rows: int = BLOCK_ROWS, sample: int = SAMPLE, most_pivots: int = PIVOTS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    good = F.coalesce((F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
                      & F.exists("v", lambda c: c != 0), F.lit(False))
    spark = vectors.sparkSession
    rows = cut(for_workers(vectors).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
               .withColumn("v", F.when(good, F.col("v"))))
    with shuffles_freed(spark):
        usable = rows.where("v is not null")
        entries = cut(usable.groupBy("v").agg(F.min("row").alias("entry"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
                      .withColumn("size", F.size("v")))
        members = cut(_members(usable, entries).unionByName(rows.where("v is null").select("row", "vec_id", F.lit(None).cast("long").alias("entry"))))
        drop_cut(rows)
        facts = cut(entries.select("entry", "least", "copies"))
        placed, near, cells = _place(entries, cosine, sample, most_pivots)
        drop_cut(entries)
    if not cells:
        return members.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    blocks = blocks_of(cells, block_rows)
    meets = {home: _merged(ranges) for home, ranges in block_partners(blocks, near).items()}
    n_blocks = max(first + many for first, many in blocks.values())
    values = block_rows * max(size for size, _ in blocks)
    side = max(1, min(-(-n_blocks // 8), SIDE_VALUES // values))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        x = np.array(frame["v"].tolist())
        single = x.astype(np.float32)
        body = {"x": single if (single == x).all() else x, "entry": frame["entry"].to_numpy(), "copies": frame["copies"].to_numpy(), "tree": CoverTree(unit(x))}
        return pd.DataFrame({"size": [frame["size"].iloc[0]], "home": [frame["home"].iloc[0]], "block": [frame["block"].iloc[0]], "body": [pickle.dumps(body)]})

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            first, count = np.array([blocks[c] for c in zip(frame["size"].tolist(), frame["cell"].tolist())], np.int64).reshape(-1, 2).T
            mixed = pd.util.hash_array(frame["entry"].to_numpy()) >> np.uint64(11)
            yield frame[["size", "entry", "copies", "v"]].assign(home=first.astype(np.int32), block=(first + mixed.astype(np.int64) % count).astype(np.int32))

    kind = dict(placed.dtypes)["v"]
    with shuffles_freed(spark):
        trees = cut(placed.mapInPandas(deal, f"size int, entry long, copies long, v {kind}, home int, block int")
                    .groupBy("size", "home", "block").applyInPandas(build, "size int, home int, block int, body binary"))
        drop_cut(placed)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        held = [(size, home, block, pickle.loads(body)) for size, home, block, body
                in frame.sort_values("block")[["size", "home", "block", "body"]].itertuples(index=False)]
        for *_, body in held:
            body["unit"] = unit(body["x"])
        first, second = map(int, frame["tile"].iloc[0].split("/"))
        out = [pd.DataFrame({"entry": [], "links": [], "leader": []}, dtype=np.int64)]
        for i, (size, home, block, a) in enumerate(held):
            for _, _, other, b in held[i:]:
                if (block // side, other // side) == (first, second) and any(lo <= other < hi for lo, hi in meets[size, home]):
                    out.append(links_between(a, b, cosine, block == other))
        return pd.concat(out, ignore_index=True)

    path = scratch_path(spark, "embedding-links")
    with shuffles_freed(spark):
        for turn, (low, high) in enumerate(rounds_of(meets, blocks, side, max(2 * n_blocks, ROUND_VALUES // values))):

            def tiles(frames: Iterator[pd.DataFrame], low: int = low, high: int = high) -> Iterator[pd.DataFrame]:
                for frame in frames:
                    for size, home, block, body in frame.itertuples(index=False):
                        own = block // side
                        for other in _sides(meets[size, home], side):
                            first, second = sorted([own, other])
                            if low <= first < high:
                                yield pd.DataFrame({"tile": [f"{first}/{second}"], "size": [size], "home": [home], "block": [block], "body": [body]})

            (trees.mapInPandas(tiles, "tile string, size int, home int, block int, body binary").groupBy("tile")
             .applyInPandas(compare, "entry long, links long, leader long").write.parquet(f"{path}/round={turn}"))
    drop_cut(trees)
    found = spark.read.schema("entry long, links long, leader long, round int").parquet(path)
    counted = found.groupBy("entry").agg(F.sum("links").alias("links"))
    labels = components(found.where("entry <> leader").select(F.col("entry").alias("u"), F.col("leader").alias("v")))
    known = (facts.join(counted, "entry", "left").join(labels, F.col("entry") == F.col("node"), "left")
             .select("entry", "copies", "least", F.coalesce("label", "entry").alias("label"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    smallest = known.groupBy("label").agg(F.min("least").alias("component"))
    by_entry = salted_lookup(known, smallest, "label", "entry").select("entry", "n_links", "component")
    joined = salted_lookup(members.where("entry is not null"), by_entry, "entry", "row").select("vec_id", "n_links", F.col("component").alias("component_id"))
    alone = members.where("entry is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))


def _hash(v: Column) -> Column:
    return F.xxhash64(v)


def _members(usable: DataFrame, entries: DataFrame) -> DataFrame:
    """(row, vec_id, entry) of ``usable(row, vec_id, v)``; ``entries`` has each v once.

    By hashes of v, which are shorter than v, unless two vectors have the same one.
    """
    hashed = entries.select(_hash(F.col("v")).alias("hash"), "entry")
    if hashed.groupBy("hash").count().where("count > 1").isEmpty():
        return salted_lookup(usable.select("row", "vec_id", _hash(F.col("v")).alias("hash")), hashed, "hash", "row").select("row", "vec_id", "entry")
    return salted_lookup(usable, entries.select("v", "entry"), "v", "row").select("row", "vec_id", "entry")


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges (first, end), apart from each other, of what sorted ranges (first, number) hold."""
    out: list[tuple[int, int]] = []
    for first, many in ranges:
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], first + many)
        else:
            out.append((first, first + many))
    return out


def _sides(ranges: list[tuple[int, int]], side: int) -> list[int]:
    """The sides that have a block of ``ranges(first, end)``, in order."""
    return sorted({s for first, end in ranges for s in range(first // side, (end - 1) // side + 1)})


def rounds_of(meets: dict[tuple[int, int], list[tuple[int, int]]], blocks: dict[tuple[int, int], tuple[int, int]], side: int, most: int) -> list[tuple[int, int]]:
    """Ranges (low, high) of tiles' first sides, whose tiles take about ``most`` copies of blocks, or are of one first side.

    A block has a copy in each tile of its side with a side that holds a partner of its.
    """
    n_sides = -(-max(first + many for first, many in blocks.values()) // side)
    copies = np.zeros(n_sides, np.int64)
    for home, (first, many) in {(size, first): (first, many) for (size, _), (first, many) in blocks.items()}.items():
        others = np.array(_sides(meets[home], side), np.int64)
        for own in range(first // side, (first + many - 1) // side + 1):
            here = min(first + many, (own + 1) * side) - max(first, own * side)
            before = others[others < own]
            copies[before] += here
            copies[own] += here * (len(others) - len(before))
    out, low, held = [], 0, 0
    for s, n in enumerate(copies.tolist()):
        if s > low and held + n > most:
            out.append((low, s))
            low, held = s, 0
        held += n
    return [*out, (low, n_sides)]


def blocks_of(cells: dict[tuple[int, int], int], block_rows: int) -> dict[tuple[int, int], tuple[int, int]]:
    """Of each (size, cell) with its number of entries: its first block and its number of blocks.

    Cells of more than ``block_rows`` entries have blocks of their own; others share blocks of at most so many. Vectors of different
    sizes never share one.
    """
    out: dict[tuple[int, int], tuple[int, int]] = {}
    free, left, of = -1, 0, None
    following = 0
    for (size, cell), n in sorted(cells.items()):
        if n > block_rows:
            many = -(-n // block_rows)
            out[size, cell] = following, many
            following += many
            continue
        if of != size or n > left:
            free, left, of = following, block_rows, size
            following += 1
        out[size, cell] = free, 1
        left -= n
    return out


def block_partners(blocks: dict[tuple[int, int], tuple[int, int]], near: dict[tuple[int, int], list[int]]) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """Of each (size, first block of a cell), the ranges (first block, number) that may hold a partner, its own included.

    By cells, not by blocks: it is as large as the pivots allow at any number of entries.
    """
    meets: dict[tuple[int, int], set[tuple[int, int]]] = {}
    for (size, cell), (first, _) in blocks.items():
        meets.setdefault((size, first), set()).update(blocks[size, c] for c in near[size, cell])
    return {k: sorted(v) for k, v in meets.items()}


def _place(entries: DataFrame, cosine: float, sample: int, most: int) -> tuple[DataFrame, dict[tuple[int, int], list[int]], dict[tuple[int, int], int]]:
    """``entries`` with their cell; of each (size, cell), the cells that may hold a partner, and the number of its entries.

    The pivots come from a sample of at most ``sample`` entries, drawn by hash.
    """
    h = F.xxhash64("entry", F.lit("pivots"))
    total = max(1, entries.count())
    below = int(-(1 << 63) + min(1.0, 2 * sample / total) * ((1 << 64) - 1))
    drawn = entries.where(h <= F.lit(min(below, (1 << 63) - 1))).orderBy(h).limit(sample).select("size", "v").toPandas()
    net = {int(s): pivots(unit(g["v"].tolist()), most) for s, g in drawn.groupby("size")}

    def centres(size: int) -> np.ndarray:
        return net.get(size, np.eye(1, size))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for size, own in frame.groupby("size"):
                d = distances(unit(own["v"].tolist()), centres(int(size)))
                cell = d.argmin(axis=1)
                far = d[np.arange(len(d)), cell].astype(np.float64)
                rest = far > CELL_RADIUS
                yield own.assign(cell=np.where(rest, d.shape[1], cell).astype(np.int32), far=np.where(rest, np.inf, far))

    kind = dict(entries.dtypes)["v"]
    placed = cut(entries.select("size", "entry", "copies", "v").mapInPandas(place, f"size int, entry long, copies long, v {kind}, cell int, far double"))
    # A row per cell: at most ``most`` + 1 of each vector length.
    found = placed.groupBy("size", "cell").agg(F.max("far").alias("reach"), F.count(F.lit(1)).alias("n")).toPandas().sort_values(["size", "cell"])
    t = np.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK
    near: dict[tuple[int, int], list[int]] = {}
    for size, own in found.groupby("size"):
        cell, reach = own["cell"].to_numpy(), own["reach"].to_numpy()
        middle = np.vstack([centres(int(size)), np.zeros((1, int(size)))])[cell]  # the rest has no centre, and is near all
        for k in range(len(cell)):
            near[int(size), int(cell[k])] = cell[distances(middle[k:k + 1], middle)[0] <= t + reach[k] + reach].tolist()
    return placed, near, {(int(x), int(c)): int(n) for x, c, n in zip(found["size"], found["cell"], found["n"])}

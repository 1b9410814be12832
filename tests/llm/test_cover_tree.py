from __future__ import annotations

import contextlib
import os
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from geofleet.llm import cover_tree as C


def clustered(rng: np.random.Generator, n: int, dims: int = 12) -> np.ndarray:
    centres = rng.normal(size=(max(2, n // 12), dims))
    x = centres[rng.integers(len(centres), size=n)] + rng.normal(scale=0.25, size=(n, dims)) * rng.random((n, 1))
    return x.astype(np.float32)


def brute(ids: list, x: list, cosine: float) -> dict:
    ok = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for v in x]
    links = np.zeros((len(x), len(x)), bool)
    for i in range(len(x)):
        for j in range(i):
            if ok[i] and ok[j] and len(x[i]) == len(x[j]):
                a, b = np.array(x[i], float), np.array(x[j], float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                links[i, j] = links[j, i] = a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine
    label = np.arange(len(x))
    while True:
        new = np.minimum(label, np.where(links, label[None, :], len(x)).min(axis=1, initial=len(x)))
        if (new == label).all():
            break
        label = new
    return {i: (i, int(links[i].sum()), min(ids[k] for k in np.flatnonzero(label == label[i]))) for i in range(len(x))}


@pytest.mark.parametrize("cosine", [0.9, 0.99, 0.5])
def test_matches_brute_force(spark, cosine):
    rng = np.random.default_rng(7)
    x = [v.tolist() for v in clustered(rng, 260)]
    x += [x[0]] * 30 + [[2 * c for c in x[1]]]                       # copies, and a multiple
    x += [(np.array(x[2]) + rng.normal(scale=0.01, size=12)).tolist() for _ in range(60)]  # a large near group
    x += [None, [], [0.0] * 12, [float("nan")] + [1.0] * 11, [float("inf")] + [1.0] * 11, [None] + [1.0] * 11, [1.0, 0.0], [1.0, 0.01], [1e30] * 12, [1e-30] * 12]
    ids = list(range(len(x)))
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in zip(ids, x)], "vec_id long, embedding array<float>, label int, entry string")
    out = C.near_duplicates(df.repartition(4), cosine=cosine, block_rows=40, sample=100, most_pivots=5).collect()
    stored = [r.embedding for r in df.orderBy("vec_id").collect()]
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == sorted(brute(ids, stored, cosine).values())
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)


def test_traversal_keeps_every_link_and_prunes():
    rng = np.random.default_rng(3)
    xa, xb = C.unit(clustered(rng, 300)), C.unit(clustered(rng, 200))
    xb[:20] = xa[:20]
    a, b = C.CoverTree(xa), C.CoverTree(xb)
    for dense in (0.0, 0.05, 1.0):      # by matrix products, mixed, by lists of pairs
        left = np.zeros((300, 200), bool)
        left[C.dual_traversal(a, b, xa, xb, np.sqrt(0.2), dense)] = True
        assert left[xa @ xb.T >= 0.9].all() and left.mean() < 0.3
    for (centres, parents, radii), r in zip(a.levels[1:-1], C.RADII):
        d = C.distances(xa[centres], xa[centres])
        assert (d[~np.eye(len(centres), dtype=bool)] > r - 1e-3).all()            # separated
        assert (C.distances(xa, xa[centres]).min(axis=1) <= r + 1e-3).all()       # covering
    for (above, _, _), (here, parents, _) in zip(a.levels, a.levels[1:]):
        assert set(above) <= set(here) and (parents < len(above)).all()           # nested


def tight(rng: np.random.Generator, n: int, clusters: int, dims: int = 64) -> np.ndarray:
    centres = C.unit(rng.normal(size=(clusters, dims)))
    return C.unit(centres[rng.integers(clusters, size=n)] + rng.normal(scale=0.01, size=(n, dims)))


@pytest.mark.parametrize("clusters", [40, 300])
def test_clustered_vectors_prune_most_pairs_of_blocks_and_copies_stay_flat(spark, clusters):
    """Copies of a block: about one at any size, where dealing cells at random gives one per block."""
    rng, per_block = np.random.default_rng(clusters), {}
    for n in (2000, 8000):
        x = tight(rng, n, clusters)
        df = spark.createDataFrame([(i, 64, 1, v) for i, v in enumerate(x.tolist())], "entry long, size int, copies long, v array<double>")
        _, near, cells = C._place(df, 0.9, 2000, 512)
        blocks = C.blocks_of(cells, 100)
        assert sum(cells.values()) == n
        width = {first: many for first, many in blocks.values()}
        copies = sum(width[home] * sum(many for _, many in ranges) for (_, home), ranges in C.block_partners(blocks, near).items())
        per_block[n] = copies / sum(width.values())
    assert per_block[8000] < 0.2 * 80 and per_block[8000] < 4 * max(1, 8000 / clusters / 100) + 2


def test_blocks_hold_each_entry_once_and_no_more_than_asked():
    cells = {(2, 0): 250, (2, 1): 30, (2, 2): 60, (2, 3): 20, (3, 0): 5}
    blocks = C.blocks_of(cells, 100)
    assert blocks == {(2, 0): (0, 3), (2, 1): (3, 1), (2, 2): (3, 1), (2, 3): (4, 1), (3, 0): (5, 1)}
    meets = C.block_partners(blocks, {(2, 0): [0, 1], (2, 1): [0, 1], (2, 2): [2], (2, 3): [3], (3, 0): [0]})
    assert meets == {(2, 0): [(0, 3), (3, 1)], (2, 3): [(0, 3), (3, 1)], (2, 4): [(4, 1)], (3, 5): [(5, 1)]}


def test_tight_groups_match_brute_force_over_many_blocks(spark):
    rng = np.random.default_rng(11)
    x = [v.tolist() for v in np.vstack([tight(rng, 400, 20, 16), C.unit(rng.normal(size=(100, 16)))]).astype(np.float32)]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<float>")
    out = C.near_duplicates(df, block_rows=25, sample=200, most_pivots=15).collect()
    stored = [r.embedding for r in df.orderBy("vec_id").collect()]
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == sorted(brute(list(range(500)), stored, 0.9).values())


def test_null_and_repeated_ids_and_empty_input(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(None, [1.0, 0.0]), (4, [1.0, 0.0]), (4, [1.0, 0.0]), (None, [0.0, 1.0]), (None, None)]
    out = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in C.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert out == sorted([(None, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (None, 0, None, True), (None, 0, None, True)], key=str)
    assert C.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    assert C.near_duplicates(spark.createDataFrame([(1, None)], schema)).count() == 1


def shuffle_bytes(spark) -> int:
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    total = 0
    for at, _, names in (x for f in folders for x in os.walk(f.getPath())):
        for name in (n for n in names if n.startswith("shuffle_")):
            with contextlib.suppress(OSError):  # it went meanwhile
                total += os.stat(os.path.join(at, name)).st_size
    return total


def test_vectors_without_structure_take_little_disk(spark, monkeypatch):
    """About equally far apart, so every block meets all 50: shuffled are a few copies of the input at a time, and no files stay."""
    monkeypatch.setattr(C, "ROUND_VALUES", 1, raising=False)
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=(1960, 64)), rng.normal(size=(1, 64)) + rng.normal(scale=0.01, size=(40, 64))]).astype(np.float32)
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<float>")
    spark.sparkContext._jvm.System.gc()
    before, most, done = shuffle_bytes(spark), [0], threading.Event()

    def watch():
        while not done.wait(0.02):
            most[0] = max(most[0], shuffle_bytes(spark) - before)

    watcher = threading.Thread(target=watch)
    watcher.start()
    out = C.near_duplicates(df, block_rows=40, sample=100, most_pivots=5)
    done.set()
    watcher.join()
    assert most[0] < 8 * x.nbytes
    got = {r.vec_id: (r.n_links, r.component_id) for r in out.collect()}
    assert got == {i: (39, 1960) if i >= 1960 else (0, i) for i in range(2000)}


def test_rounds_hold_about_twice_the_blocks_and_each_tile_once():
    for n, side in ((50, 7), (64, 8), (9, 1), (3, 8)):
        blocks = {(2, 0): (0, n - 2), (2, 1): (n - 2, 2)}
        meets = {(2, 0): [(0, n)], (2, n - 2): [(0, n)]}
        rounds = C.rounds_of(meets, blocks, side, 2 * n)
        sides = -(-n // side)
        assert [x for low, high in rounds for x in range(low, high)] == list(range(sides))
        for low, high in rounds:
            copies = sum(sum(low <= min(b // side, s) < high for s in range(sides)) for b in range(n))
            assert copies <= 2 * n or high == low + 1


@pytest.mark.parametrize("clash", [False, True])
def test_rows_find_their_vector_also_where_hashes_clash(spark, monkeypatch, clash):
    if clash:
        monkeypatch.setattr(C, "_hash", lambda v: F.lit(1).cast("long"))
    rows = [(1, [1.0, 0.0]), (2, [1.0, -0.0]), (3, [0.0, 1.0]), (4, [0.1, 1.0]), (5, None), (3, [1.0, 0.0])]
    out = C.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == [(1, 2, 1), (2, 2, 1), (3, 1, 3), (3, 2, 1), (4, 1, 3), (5, 0, 5)]

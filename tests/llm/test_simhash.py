from __future__ import annotations

import random
import re
import time

import pytest
import xxhash
from pyspark.sql import functions as F

from geofleet.llm import simhash as S
from geofleet.llm.common import components
from tests.llm.helpers import documents


def brute(text: str | None, words: int = 3) -> int:
    parts = (text or "").encode().lower().split()
    shingles = [b" ".join(parts[i:i + words]) for i in range(max(1, len(parts) - words + 1))] if parts else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(values: dict, max_bits: int) -> dict:
    """Smallest key reachable by values that differ in max_bits or fewer bits."""
    keys, label = list(values), {k: k for k in values}
    changed = True
    while changed:
        changed = False
        for a in keys:
            for b in keys:
                if (values[a] ^ values[b]).bit_count() <= max_bits and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def near(rng: random.Random, n: int) -> list[int]:
    """Fingerprints in clusters: random ones, and copies with up to 4 flipped bits."""
    out = []
    while len(out) < n:
        x = rng.getrandbits(64)
        out.append(x)
        for _ in range(rng.randint(0, 6)):
            y = x
            for b in rng.sample(range(64), rng.randint(1, 4)):
                y ^= 1 << b
            out.append(y)
    return list(dict.fromkeys([*out, 0, (1 << 64) - 1, 1 << 63, 1]))


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3, 4, 5])
def test_links_are_all_pairs_within_the_distance(spark, max_bits):
    fps = near(random.Random(max_bits), 300)
    signed = [S._signed(x) for x in fps]
    out = S.links(spark.createDataFrame([(x,) for x in signed], "fp long"), max_bits)
    found = [tuple(r) for r in out.collect()]
    expected = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= max_bits}
    assert len(found) == len(set(found)) and set(found) == expected


def test_fingerprint_is_brute_force(spark):
    rng = random.Random(2)
    texts = ["", None, "one", "two words", "a b c", "A B\tC\x0b\x0cD", "É é Ñ", "x y z w", "\x1c a b"] + [
        " ".join(rng.choice("abcdef") for _ in range(rng.randint(1, 60))) for _ in range(40)]
    for t in texts:
        assert S.fingerprint(t) == brute(t) == S.fingerprint(t, chunk=7)
    long = " ".join(str(i % 977) for i in range(60_000))
    assert S.fingerprint(long) == brute(long)
    df = spark.createDataFrame([(t,) for t in texts if t and len(t.split()) == 3], "t string")
    one = df.select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert S.fingerprint("a b c") == one & ((1 << 64) - 1)


def test_groups_match_brute_force(spark):
    rng = random.Random(4)
    base = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randint(0, 50)) for _ in range(200))
    rows = [(i, base) for i in range(20)] + [(20 + i, base.replace(f"alpha{i} ", "omega ")) for i in range(40)]
    rows += [(100 + i, f"word{i} unique{i} text{i} more{i}") for i in range(40)] + [(200, None), (201, ""), (202, " \t"), (203, base.upper()), (7, base)]
    df = documents(spark, rows, "fp component_id label node")
    out = S.simhash_groups(df).collect()
    fps = {d: brute(t) for d, t in rows}
    label = grouped(fps, 2)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in out) == sorted((d, f"{brute(t):016x}", label[d]) for d, t in rows)
    kept = S.keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted({r.doc_id for r in kept.collect()}) == sorted({d for d in label if label[d] == d})


def test_each_group_keeps_one_row(spark):
    near, far, other = "one two three four five six", "red green blue white black grey", "la le li lo lu ly"
    rows = [(1, near), (2, near), (2, far), (3, far), (7, other), (7, other), (7, other), (8, "up down"), (8, "UP down"), (9, "up down"),
            (None, far), (None, far)]
    kept = sorted(((r.doc_id or 0, r.text.lower()) for r in S.keep_one_of_each(documents(spark, rows)).collect()))
    assert kept == [(0, far), (0, far), (1, near), (2, far), (7, other), (8, "up down")]
    rows = [(5, near), (5, far), (6, near), (6, far)]
    assert sorted((r.doc_id, r.text) for r in S.keep_one_of_each(documents(spark, rows)).collect()) == [(5, near), (5, far)]


def test_null_ids_and_empty_input(spark):
    rows = [(None, "a b c d"), (5, "a b c d"), (None, "alone here now")]
    out = {(r.doc_id, r.component_id) for r in S.simhash_groups(documents(spark, rows)).collect()}
    assert out == {(None, 5), (5, 5), (None, None)}
    assert S.simhash_groups(documents(spark, [])).count() == 0
    assert S.keep_one_of_each(documents(spark, [])).count() == 0


def test_components_of_paths_cliques_and_stars(spark):
    edges = [(i, i + 1) for i in range(100)] + [(a, b) for a in range(200, 215) for b in range(200, 215)] + [(300, i) for i in range(301, 340)] + [(500, 500)]
    out = components(spark.createDataFrame(edges, "u long, v long")).collect()
    sets = {}
    for r in out:
        sets.setdefault(r.label, set()).add(r.node)
    assert sorted(map(sorted, sets.values())) == [list(range(101)), list(range(200, 215)), list(range(300, 340))]
    assert all(label in nodes for label, nodes in sets.items())


@pytest.mark.parametrize("max_bits", [2, 3])
def test_hot_variants_keep_every_link(spark, max_bits):
    """Fingerprints that share one half, three quarters or all but ten bits, so that groups are cut again and again."""
    rng = random.Random(max_bits)
    high = rng.getrandbits(64)
    fps = {(high >> keep << keep) | rng.getrandbits(keep) for keep in (10, 16, 32) for _ in range(40)}
    for fp in list(fps)[:40]:
        for k in range(1, max_bits + 2):
            fps.add(fp ^ sum(1 << b for b in rng.sample(range(64), k)))
    want = {(u, v) for u in map(S._signed, fps) for v in map(S._signed, fps) if u < v and ((u ^ v) & (1 << 64) - 1).bit_count() <= max_bits}
    df = spark.createDataFrame([(S._signed(f),) for f in fps], "fp long")
    got = [(r.u, r.v) for r in S.links(df, max_bits, hot=4).collect()]
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("hot", [64, 2])
def test_an_index_is_never_broadcast(spark, hot):
    """However few the fingerprints: an index is tens of times what Spark takes it for."""
    rng = random.Random(hot)
    fps = spark.createDataFrame([(5 << 32 | rng.getrandbits(32),) for _ in range(200)], "fp long").repartition(2).distinct()
    found = S.links(fps, hot=hot)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"(\w+Join) .*Inner", plan)) == {"SortMergeJoin"}, plan


def test_a_shared_half_costs_about_as_much_as_none(spark):
    rng = random.Random(9)

    def took(high):
        df = spark.createDataFrame([(S._signed(high() << 32 | rng.getrandbits(32)),) for _ in range(16_000)], "fp long").cache()
        df.count()
        started = time.time()
        S.links(df).count()
        return time.time() - started

    took(lambda: rng.getrandbits(32))
    plain = took(lambda: rng.getrandbits(32))
    assert took(lambda: 12345) < max(3 * plain, 12)

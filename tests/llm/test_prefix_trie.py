from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from geofleet.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(rows):
    """conv -> turns in order; ties go by the digest that the operator states."""
    out: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            out.setdefault(c, []).append(((turn is not None, turn or 0, digest), (role, text)))
    return {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in out.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return out


def brute(convs):
    members: dict[tuple, list[int]] = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for prefix, own in members.items():
        below = [p for p in members if p[:len(prefix)] == prefix]
        children = [p for p in below if len(p) == len(prefix) + 1]
        ends = sorted(c for c in own if len(convs[c]) == len(prefix))
        out.append((min(own), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(own), len(children),
                    sum(not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in below) for p in below),
                    sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0], r[1]))


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=lambda r: (r[0], r[1]))


def made(seed, convs=60, longest=11):
    """Few different turns, so that conversations share prefixes and diverge at every place in a block."""
    rng, rows = random.Random(seed), []
    for c in range(convs):
        n = rng.randint(1, longest)
        rows += [(c * 7, t, "user" if t % 2 else "assistant", rng.choice(["a", "a", "a", "bé", ""])) for t in range(n)]
    return rows


@pytest.mark.parametrize("block", [1, 3, 4])
def test_tree_equals_brute_force(spark, block):
    rows = made(block)
    assert got(P.prefix_trie(spark.createDataFrame(rows, SCHEMA), block=block)) == brute(sequences(rows))


def test_rebuilt_conversations_equal_brute_force(spark):
    rows = [(c + 95, t, r, x) for c, t, r, x in made(5, convs=40)]  # bases 100, 200, 300 are there or not
    rows += [(200, t, "user", f"base {t}") for t in range(3)]
    turns, convs = P.graft(P.number_turns(spark.createDataFrame(rows, SCHEMA)))
    assert got(P.trie(turns, convs)) == brute(rebuilt(sequences(rows)))


def test_sums_carry_over_chunks(spark):
    """Paths of many chunks: a chunk of two blocks or turns."""
    long = [(1, t, "u", str(t)) for t in range(23)] + [(2, t, "u", str(t)) for t in range(17)] + [(3, t, "u", str(t) if t < 9 else "x") for t in range(20)]
    assert got(P.prefix_trie(spark.createDataFrame(long, SCHEMA), block=2, chunk=2)) == brute(sequences(long))


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(1, None, None, None), (1, 0, "u", "x"), (1, 0, "u", "x"), (1, 0, "u", "w"), (2, None, "", ""), (2, 0, "u", "x"),
            (None, 0, "u", "lost"), (3, 5, "u", "é" * 5000), (1, 1, None, "long " * 100_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS at", "2 AS key", "3 AS conv", "4 AS depth", "'x' AS digest")
    assert got(P.prefix_trie(df)) == brute(sequences(rows))


def test_same_conversation_many_times(spark):
    rows = [(c, t, "u", str(t)) for c in range(300) for t in range(6)]
    out = got(P.prefix_trie(spark.createDataFrame(rows, SCHEMA)))
    assert out == brute(sequences(rows)) and len(out) == 7


def test_conversation_of_one_key_is_numbered_in_many_tasks(spark):
    rows = spark.range(40_000).selectExpr("IF(id < 30000, 1, id) AS conv_id", "id AS turn", "'u' AS role", "CAST(id AS STRING) AS text").repartition(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        turns = P.number_turns(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert [r["at"] for r in turns.where("conv = 1").orderBy("at").collect()] == list(range(30_000))
    assert turns.where("conv <> 1 AND at > 0").count() == 0


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert got(P.prefix_trie(empty)) == []
    assert got(P.trie(*P.graft(P.number_turns(empty)))) == []

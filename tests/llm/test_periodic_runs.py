from __future__ import annotations

import random
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from geofleet.llm import periodic_runs as R
from geofleet.llm import queries as Q
from tests.llm.helpers import by_id, documents


def brute(ids):
    n, out = len(ids), []
    for q in range(1, n // 4 + 1):
        s = 0
        while s < n:
            e = s + q
            while e < n and ids[e] == ids[e - q]:
                e += 1
            if e - s >= max(6, 4 * q) and not any(all(ids[i] == ids[i - d] for i in range(s + d, e)) for d in range(1, q)):
                out.append((s, e - s, q))
            s = max(s + 1, e - q + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 7), st.integers(0, 8)), max_size=6))
def test_runs_equal_brute_force(parts):
    ids = [x for block, times, cut in parts for x in block * times + block[:cut]]
    assert R.runs(np.array(ids, np.int64)) == brute(ids)


def test_long_periods_and_nested_runs():
    rng = random.Random(3)
    for period in (6, 7, 21, 22, 23, 69, 70, 71, 150):
        block = [rng.randrange(2) for _ in range(period)]
        inner = [5] * 9
        for body in (block * 5 + block[:period // 2], (block + inner) * 4):
            ids = [9, 8, *body, 7, *block]
            assert R.runs(np.array(ids, np.int64)) == brute(ids)


def test_one_word_and_one_block_a_million_times():
    started = time.time()
    assert R.runs(np.zeros(1_000_000, np.int64)) == [(0, 1_000_000, 1)]
    assert R.runs(np.tile(np.arange(1000), 500)) == [(0, 500_000, 1000)]
    rng = np.random.default_rng(1)
    assert R.runs(rng.integers(0, 50_000, 1_000_000)) == []
    assert time.time() - started < 60


def test_operator_over_rows(spark):
    texts = {1: "a " * 6, 2: "a\tb\n" * 4 + "c", 3: None, 4: "", 5: " \n", 6: "a a a a a", 7: "x " + "A b " * 3 + "A a", 8: "é é é " * 5, 9: "w " * 300_000}
    df = documents(spark, [*texts.items(), (None, "q q q q q q q"), (1, texts[1])], "runs collapsed n_words")
    out = R.periodic_runs(df)
    assert out.count() == 11
    for k, row in by_id(out.where("doc_id is not null")).items():
        words = (texts[k] or "").encode().split()
        found = [(r["start"], r["length"], r["period"]) for r in row["runs"]]
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        ids = [number[w] for w in words]
        assert row["n_words"] == len(words) and found == (brute(ids) if k != 9 else [(0, 300_000, 1)])
        assert row["collapsed"] == collapsed([w.decode() for w in words], found)
    assert out.where("doc_id is null").first()["collapsed"] == "q"
    assert R.periodic_runs(df.limit(0)).count() == 0


def test_query_equals_brute_force(spark, tmp_path):
    import hashlib
    import zlib

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(100_000 + i, "one two three " * (i % 9) + " end") for i in range(100)] + [(100_200, None)]
    documents(spark, rows).coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    out = by_id(Q.op13_periodic_runs(spark, str(tmp_path)))
    planted = 0
    for doc, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        h, n = zlib.crc32(str(doc).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        found = brute([number[w] for w in words]) if n < 1000 else R.runs(np.array([number[w] for w in words]))
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        assert out[doc] == {
            "doc_id": doc, "n_runs": len(found), "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": 1000 * best[1] // best[2] if found else None,
            "runs_sha256": hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(collapsed(words, found).encode()).hexdigest()}, doc
    assert planted > 10

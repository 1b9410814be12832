from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from geofleet.llm import exact_dedup as E
from geofleet.llm.common import UPPER
from tests.llm.helpers import documents

ROWS = ([(i, "Hot Copy" if i % 2 else "hot copy") for i in range(0, 90)] + [(100 + i, f"text {i % 40}") for i in range(120)]
        + [(300, None), (301, ""), (302, " "), (303, "É"), (304, "é"), (305, "long " * 50_000), (306, "LONG " * 50_000)]
        + [(400, "twice"), (400, "twice"), (None, "no id"), (None, "No id"), (None, "half"), (500, "half")])


def expected():
    groups = {}
    for d, t in ROWS:
        groups.setdefault((t or "").translate(str.maketrans(UPPER, UPPER.lower())), []).append(d)
    out = []
    for norm, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), keep is None or i == keep, hashlib.sha256(norm.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("digest", [E.sha256, lambda c: F.substring(F.sha2(c, 256), 1, 1)], ids=["sha256", "colliding"])
@pytest.mark.parametrize("hot_share", [1, 3, 10_000])
def test_groups_match_brute_force(spark, digest, hot_share):
    df = documents(spark, ROWS, "digest norm salt keep_id").repartition(5)
    out = E.duplicate_groups(df, salts=4, hot_share=hot_share, digest=digest)
    assert sorted((tuple(r) for r in out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str) == expected()


@pytest.mark.parametrize("hot_share", [3, 10_000])
def test_one_row_of_each_group_stays_whole(spark, hot_share):
    df = documents(spark, ROWS, "digest norm salt row")
    out = E.drop_duplicates_exact(df, salts=4, hot_share=hot_share)
    assert out.columns == df.columns
    kept = {r[4]: r[1] for r in expected()}
    rows = out.collect()
    assert len(rows) == len(kept) and sorted((r.doc_id for r in rows), key=str) == sorted(kept.values(), key=str)
    by_id = {(d, t): None for d, t in ROWS}
    assert all((r.doc_id, r.text) in by_id and r.norm == (f"x{r.doc_id}" if r.doc_id is not None else None) for r in rows)


def test_empty_input(spark):
    assert E.duplicate_groups(documents(spark, [])).count() == 0
    assert E.drop_duplicates_exact(documents(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    for df in (E.duplicate_groups(documents(spark, ROWS)), E.drop_duplicates_exact(documents(spark, ROWS))):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Cartesian" not in plan

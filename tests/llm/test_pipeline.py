from __future__ import annotations

import random
import re
import zlib

import corpus_pipeline
from geofleet.llm import mixing, packing, simhash, toxicity
from geofleet.llm.common import UPPER, table
from geofleet.llm.queries import QUERIES, SQL, tokenizer_path
from tests.llm.helpers import documents
from tests.llm.test_simhash import grouped

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_match_brute_force(spark):
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in toxicity.score(docs, table(spark, SF, "labels")).collect() if r.predicted}
    left = sorted(set(rows) - toxic)
    same = {}
    for d in left:
        same[(rows[d] or "").translate(str.maketrans(UPPER, UPPER.lower()))] = d  # ascending: the largest stays
    left = sorted(same.values())
    label = grouped({d: simhash.fingerprint(rows[d]) for d in left}, simhash.MAX_BITS)
    left = {d for d in left if label[d] == d}

    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == left
    words = packing.tokenizer_at(tokenizer_path())
    for d in left:
        ids = words.encode(rows[d] or "") + packing.pack_ids([packing.END_ID])
        pieces = sorted((r.start, r.length, r.ids_crc32) for r in out if r.doc_id == d)
        assert sum(n for _, n, _ in pieces) == len(ids) // 4
        assert all(zlib.crc32(ids[4 * s:4 * (s + n)]) == c for s, n, c in pieces)


def test_stages_but_the_last_return_documents(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "mix_sources", "pack_sequences"]


def test_the_near_copies_stage_never_broadcasts_an_index(spark, monkeypatch):
    linked, components = [], simhash.components
    monkeypatch.setattr(simhash, "components", lambda edges: linked.append(edges) or components(edges))
    corpus_pipeline.drop_near_copies(spark, table(spark, SF, "documents"), SF)
    plan = linked[0]._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"(\w+Join) .*Inner", plan)) == {"SortMergeJoin"}, plan


def test_sequences_follow_the_mix(spark, workdir):
    """Files of unequal size, several to a scan partition: source shares over sequence_id stay near the targets."""
    rng = random.Random(2)
    sizes = {"a": 3200, "b": 1200, "c": 400}
    rows = [(i, "alpha beta " * rng.randint(1, 60 if i % 7 else 900), s) for i, s in enumerate(x for x, n in sizes.items() for _ in range(n))]
    docs = documents(spark, rows)
    weights = spark.createDataFrame([(s, float(n)) for s, n in sizes.items()], "source string, weight double")
    mixing.in_mixed_order(docs, weights, files=9, block_rows=4).write.parquet(f"{workdir}/mixed")
    mixed = spark.read.parquet(f"{workdir}/mixed")
    order = mixing.mix(docs, weights, block_rows=4).toPandas().set_index("doc_id").mix_position.rank()
    out = packing.pack_in_order(mixed, tokenizer_path(), window=512, slice_windows=16).toPandas()
    assert sorted(out[out.start == 0].doc_id) == [r[0] for r in rows]
    docs_in_order = out.sort_values(["sequence_id", "offset"]).drop_duplicates("doc_id", keep="last").doc_id
    moved = (order[docs_in_order].to_numpy() - range(1, len(rows) + 1))
    assert abs(moved).max() < 400
    source = {r[0]: r[2] for r in rows}
    seen = dict.fromkeys(sizes, 0)
    for t, d in enumerate(docs_in_order, start=1):
        seen[source[d]] += 1
        assert all(abs(seen[s] - t * n / len(rows)) < 120 for s, n in sizes.items())


def test_stages_take_empty_input(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_every_operators_query_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(SQL) <= set(QUERIES)

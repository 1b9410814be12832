from __future__ import annotations

import random
import zlib
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from geofleet.llm import packing
from geofleet.llm.queries import tokenizer_path
from tests.llm.helpers import documents


@pytest.fixture(scope="module")
def words():
    return packing.WordTokenizer(tokenizer_path())


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcéßÀİΣ σ.,'!1\n\t\x1ć  <|>"), st.characters()), max_size=40))
def test_ids_are_the_tokenizers(words, text):
    if any(0xD800 <= ord(c) < 0xE000 for c in text):
        return
    expected = words.tokenizer.encode(text, add_special_tokens=False).ids
    assert words.encode(text) == packing.pack_ids(expected)


def test_special_strings_and_marks(words):
    for text in ("<|endoftext|> x", "don't. we'll, it's", "a.b,c.. d.,", "word. word, WORD.", "é. Été, ñandú", "ǅ ŉ ﬁ", "x\x1fy z"):
        assert words.encode(text) == packing.pack_ids(words.tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def contract():
    """The tokenizer as its file says, nothing set on it."""
    return Tokenizer.from_file(tokenizer_path())


def test_added_tokens_are_the_contracts(words, contract):
    assert contract.encode("a <|endoftext|> b", add_special_tokens=False).ids == [320, 49407, 321]
    for text in ("a <|endoftext|> b", "<|startoftext|>a<|endoftext|>", "x<|endoftext|>y z", "<|ENDOFTEXT|> a", "<|EndOfText|><|endoftext|>", "<|endoftext| >",
                 "<|endoftext|>\u0338", "a <|endof text|> b"):
        assert words.encode(text) == packing.pack_ids(contract.encode(text, add_special_tokens=False).ids), text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", " ", "Word", "é", ".", "\n"]), max_size=8).map("".join))
def test_ids_are_those_of_a_fresh_tokenizer(words, contract, text):
    assert words.encode(text) == packing.pack_ids(contract.encode(text, add_special_tokens=False).ids)


def test_fill_is_closest_to_the_room():
    rng = random.Random(3)
    for _ in range(60):
        items = [rng.randint(1, 30) for _ in range(9)]
        counts = {k: items.count(k) for k in items}
        best = max(s for r in range(10) for c in combinations(items, r) if (s := sum(c)) <= 50)
        chosen = dict(packing.fill(sorted(counts.items(), reverse=True), 50))
        assert sum(k * n for k, n in chosen.items()) == best and all(n <= counts[k] for k, n in chosen.items())


def test_all_lengths_are_packed_once():
    rng = random.Random(5)
    counts = {rng.randint(1, 99): rng.randint(1, 50) for _ in range(40)}
    left = dict(counts)
    for chosen, times in packing.minimum_bin_slack(counts, 100):
        assert times >= 1 and sum(k * n for k, n in chosen) <= 100
        for k, n in chosen:
            left[k] -= n * times
    assert not any(left.values())


def check(out, docs, words, window):
    """Pieces cover every document's ids exactly once, and sequences without gaps."""
    copies = {}
    for d, text in docs:
        copies.setdefault(d, []).append(words.encode(text or "") + packing.pack_ids([packing.END_ID]))
    got = {}
    for r in out:
        got.setdefault(r.doc_id, []).append(r)
    assert set(got) == set(copies)
    for d, ids in copies.items():
        assert sum(r.length for r in got[d]) == sum(len(x) // 4 for x in ids)
        if len(ids) == 1:
            at = 0
            for r in sorted(got[d], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids[0]) // 4
                at += r.length
                assert zlib.crc32(ids[0][4 * r.start:4 * at]) == r.ids_crc32
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append(r)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return sequences


def test_pack_round_trip_and_edge_rows(spark, words):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice(["alpha", "the", "Überall", "x1."]) for _ in range(rng.randint(1, 400)))) for i in range(150)]
    docs += [(500, None), (501, ""), (502, "long " * 30_000), (503, "same"), (503, "same"), (None, "no id")]
    df = documents(spark, docs, "start length sequence_id").repartition(3, "doc_id")
    out = packing.pack(df, tokenizer_path(), window=512).collect()
    sequences = check(out, docs, words, 512)
    total = sum(r.length for r in out)
    assert total / (512 * len(sequences)) > 0.97
    assert [(r.length, r.doc_tokens) for r in out if r.doc_id in (500, 501)] == [(1, 1)] * 2


def test_empty_input(spark):
    out = packing.pack(documents(spark, []), tokenizer_path())
    assert out.count() == 0 and out.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_no_shuffle(spark):
    plan = packing.pack(documents(spark, [(1, "a")]), tokenizer_path())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan

from __future__ import annotations

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from geofleet.llm import pii
from tests.llm.helpers import by_id, documents

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def brute(text: str | None) -> list[tuple[int, int, int]]:
    t = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    luhn = lambda d: sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(t)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


def listed(spans) -> str:
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans)


ROWS = [
    (1, "é mail me: a.b+c@x.example.com. or a@b.c@d.e or @x.y or x@y, call +1 (213) 555-2625!"), (2, None), (3, ""), (4, "10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.004 1.2.3"),
    (5, "card 4111 1111 1111 1111, 4111-1111-1111-1112 pay 378282246310005 and 0000000000000"), (6, "𝔘 +49 30 901820 +1 23 +123456789012345678"),
    (7, "ssn 123-45-6789, Dr. Anna Smith (555) 123-4567 or joe [at] mail [dot] com, 2024-01-02"), (8, "w" * 200_000 + " z@y.org " + "9" * 12_000 + " " + "1." * 4_000),
    (9, "same a@b.org"), (9, "same a@b.org"), (None, "c@d.net"), (10, "no data"),
]


def test_base_spans_match_brute_force_and_edge_rows(spark):
    out = pii.scan(documents(spark, ROWS, "kept spans kind findings").repartition(3)).collect()
    assert len(out) == len(ROWS)
    texts = {r[0]: r[1] for r in ROWS}
    for r in out:
        spans = brute(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for k, _, _ in spans) for n in range(4)], r
        assert r.base_sha256 == hashlib.sha256(listed(spans).encode()).hexdigest(), r.doc_id
        assert r.spans.startswith(listed(spans)) and all(0 <= f.probability <= 1 for f in r.findings)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(alphabet=st.sampled_from("a1 @.-_+()%é5"), max_size=60), st.text(alphabet=st.sampled_from("12.. a"), max_size=40)))
def test_candidates_of_random_texts(text):
    assert sorted(c for c in pii.candidates(text) if c[0] < pii.BASE_KINDS) == brute(text)


def test_long_runs_are_read_in_linear_time():
    text = "9" * 2_000_000 + " " + "w" * 2_000_000 + "@" + "x" * 2_000_000 + " +1" + " " * 1_000_000
    assert list(pii.candidates(text)) == []


def test_looser_candidates_are_found_and_judged(spark):
    good = [(i, f"my ssn: 123-45-{1000 + i} call (555) 123-{4000 + i} mail: u{i}@x.com from 10.0.0.{i % 200}") for i in range(200)]
    bad = [(1000 + i, f"part x000-00-0000y and zz(111)222-33334") for i in range(50)]
    out = by_id(pii.scan(documents(spark, good + bad)))
    assert "ssn:" in out[3]["spans"] and "local:" in out[3]["spans"]
    assert "local:" not in out[1000]["spans"]


def test_reliabilities_find_the_noisy_labeler():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    correct = np.array([0.95, 0.9, 0.85, 0.55, 0.5])
    vote = np.where((rng.random((4000, 5)) < correct) == truth[:, None], 1, 2)
    p, rate, prior = pii.reliabilities(np.zeros(4000, int), vote, np.ones(4000))
    assert ((p > 0.5) == truth).mean() > 0.95 and abs(prior[0] - 0.4) < 0.05
    assert rate[1][0] - rate[0][0] > 0.7 > 0.3 > rate[1][4] - rate[0][4]


def test_classifier_learns_the_targets():
    word, shape = pii.FEATURES[1] * pii.FEATURES[2] * pii.FEATURES[3], pii.FEATURES[2] * pii.FEATURES[3]
    bits = np.array([word * 3, word * 5, word * 3 + shape, word * 5 + shape * 2])
    w = pii.train(bits, np.full(4, 500.0), np.array([0.95, 0.1, 0.9, 0.05]))
    at = [w[0] + sum(w[p[i]] for p in pii._places(bits)) for i in range(4)]
    assert at[0] > 1.5 and at[2] > 1.5 and at[1] < -1.5 and at[3] < -1.5


def iban(n: int) -> str:
    body = f"DE00{37040044000000 + n:018d}"
    check = 98 - int("".join(str(int(c, 36)) for c in body[4:] + body[:4])) % 97
    text = f"DE{check:02d}{body[4:]}"
    return " ".join(text[i:i + 4] for i in range(0, len(text), 4))


def planted(n: int) -> tuple[list[tuple], dict[int, set[tuple[str, str]]]]:
    """Rows in four languages; what each holds of (kind, text). Every second row has look-alikes that aren't personal data."""
    phones = (f"020 7946 {1000 + n}", f"030 {9018000 + n}", f"01 23 45 67 {10 + n % 80}", f"612 345 {100 + n % 800}")
    people, born = ("Mary Hill", "Hans Vogel", "Claire Blanc", "Luis Campo"), f"{1 + n % 28:02d}.{1 + n % 12:02d}.19{50 + n % 50}"
    streets = (f"{12 + n % 80} Church Road", f"Bahnhofstra\u00dfe {1 + n % 90}", f"{1 + n % 90} rue de la Paix", f"calle Mayor {1 + n % 90}")
    say = ("Hello, my name is {0}, born {1}. Call {2}. I live at {3}. IBAN {4}.", "Guten Tag, ich hei\u00dfe {0}, geboren {1}. Tel {2}. Ich wohne {3}. Konto {4}.",
           "Bonjour, je m'appelle {0}, n\u00e9 le {1}. Tel {2}. J'habite {3}. Compte {4}.", "Hola, me llamo {0}, nacido {1}. Tel {2}. Vivo en {3}. Cuenta {4}.")
    at = n % 4
    truth = {("name", people[at]), ("birth", born), ("national", phones[at]), ("street", streets[at]), ("iban", iban(n))}
    noise = f"Release 01.13.20{10 + n % 80} of part x00 0000 00000 and AB12 3456 7890 1234 {1000 + n}."
    return [(2 * n, say[at].format(people[at], born, phones[at], streets[at], iban(n))), (2 * n + 1, noise)], {2 * n: truth, 2 * n + 1: set()}


def test_added_spans_on_planted_rows_in_four_languages(spark):
    rows, truth = [], {}
    for n in range(120):
        more, held = planted(n)
        rows, truth = rows + more, truth | held
    right = found = held = 0
    for r in pii.scan(documents(spark, rows)).collect():
        text = dict(rows)[r.doc_id]
        got = {(f.kind, text[f.start:f.end]) for f in r.findings}
        right, found, held = right + len(got & truth[r.doc_id]), found + len(got), held + len(truth[r.doc_id])
    assert right / held >= 0.9 and right / found >= 0.9, (right, found, held)


def test_empty_input(spark):
    assert pii.scan(documents(spark, [])).count() == 0

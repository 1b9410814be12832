"""Operator 8: personal data by weak supervision.

1. Candidates: the base patterns' matches (emails, IP addresses, payment cards, phone numbers), and looser ones that the method may add
   (social security numbers, bank accounts, dates of birth, phone numbers without a plus, spelled-out emails, names after a title or an
   introduction, street addresses; in English, German, French and Spanish). One map over whole texts.
2. Labelers vote on each candidate: yes, no, or nothing to say. Patterns (strict format, valid structure or checksum), gazetteers (top-level
   domains, number prefixes, given names, street words), context (words before it), isolation.
3. Spark counts the candidates by kind and votes: at most kinds x 3 ** labelers rows, whatever the data. For each kind,
   expectation-maximisation estimates every labeler's reliability and the kind's rate, without labels, and gives each combination a probability.
4. For each kind a logistic classifier is trained on features that no labeler sees (the word before, hashed; the span's shape, hashed; what follows;
   where in the text), with these probabilities as its targets, over counts by kind and features, so over all candidates. Its weights are
   applied in the plan. A span's probability is the mean of the labelers' log odds and the classifier's.

The base spans always stay; the probability decides which looser candidates are added.

Defined results: a null text counts as empty; repeated rows are one row each; null ids are passed on; spans of different kinds may overlap, as each kind
is found by itself; empty input gives no rows; extra columns are ignored; without spans the list is an empty string, and base_sha256 that of the empty string.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geofleet.llm.common import cut, for_workers

#: Fixed patterns of the base kinds.
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: ``[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)``. It can only fail for what follows a run of digits, so it is tried from the
#: run's first digit alone; else a long run would be read once for each of its digits.
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(\.[0-9]++){3}")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Looser candidates.
SSN = re.compile(r"[0-9]{3}(?<![0-9-]...)-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL = re.compile(r"\([0-9]{3}\)[ -]?[0-9]{3}[ -][0-9]{4}(?![0-9])")
SPELLED = re.compile(r"[A-Za-z0-9._-]{2,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]+(?: ?(?:[(\[]dot[)\]]|\.) ?[A-Za-z]{2,})+")
TITLED = re.compile(r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra?)\.? [A-Z\u00c0-\u00dd][a-z\u00df-\u00ff]+(?: [A-Z\u00c0-\u00dd][a-z\u00df-\u00ff]+)?")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?<![A-Za-z0-9]....)(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
DATE = re.compile(r"(?<![0-9./-])(?:[0-9]{1,2}([./-])[0-9]{1,2}\1(?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2})(?![0-9-])")
NATIONAL = re.compile(r"(?<![0-9+.-])(?:0[0-9]{1,4}(?:[ /-][0-9]{2,8}){1,5}|[69][0-9]{2}(?: [0-9]{3}){2}|[2-9][0-9]{2}[-.][0-9]{3}[-.][0-9]{4})(?![0-9])")
INTRODUCED = re.compile(r"(?:[Mm]y name is|[Ii]ch hei\u00dfe|[Mm]ein Name ist|[Jj]e m'appelle|[Mm]on nom est|[Mm]e llamo|[Mm]i nombre es) "
                        r"([A-Z\u00c0-\u00dd][a-z\u00df-\u00ff]+(?: [A-Z\u00c0-\u00dd][a-z\u00df-\u00ff]+){0,2})")
STREET = re.compile(r"[0-9]{1,5} [A-Z][a-z]{2,20} (?:Street|St|Road|Rd|Avenue|Ave|Lane|Drive)\b|[A-Z][a-z\u00df-\u00ff]{2,20}(?:stra\u00dfe|strasse|weg|platz|gasse) [0-9]{1,4}[a-z]?\b"
                    r"|[0-9]{1,4},? (?:rue|avenue|boulevard|place) (?:de la |du |des |de )?[A-Z\u00c0-\u00dd][a-z\u00df-\u00ff]{2,20}|(?:[Cc]alle|[Aa]venida|[Pp]laza) (?:de la |del |de )?[A-Z\u00c0-\u00dd][a-z\u00df-\u00ff]{2,20},? [0-9]{1,4}\b")
KINDS = ("email", "ip", "card", "phone", "ssn", "local", "spelled", "name", "iban", "birth", "national", "street")
BASE_KINDS = 4
#: Gazetteers and context words, by kind.
TOP_LEVEL = set("com org net edu gov io co uk de fr es eu us info biz".split())
COUNTRY_CODES = ("1", "33", "34", "39", "44", "49", "52", "54", "61", "81", "86", "91")
ISSUERS = ("4", "34", "37", "51", "52", "53", "54", "55", "6011", "62", "65")
GIVEN_NAMES = set("james mary john linda robert susan michael sarah david anna thomas laura peter julia paul marie pierre claire jean sophie hans karl "
                  "petra carlos maria jose ana luis lucia".split())
TITLES = set("mr mrs ms dr prof herr frau mme sr sra".split())
STREET_WORDS = set("main high church park mill station market king queen haupt bahnhof schul kirch berg victor republique gare paix mayor sol real".split())
CONTEXT = {
    "email": ("mail", "contact", "write", "reach", "kontakt", "correo"), "ip": ("ip", "host", "server", "address", "login", "from"),
    "card": ("card", "visa", "credit", "pay", "carte", "karte", "tarjeta"), "phone": ("phone", "call", "tel", "mobile", "fax", "cell"),
    "ssn": ("ssn", "social", "security"), "local": ("phone", "call", "tel", "mobile", "fax", "cell"), "spelled": ("mail", "contact", "write", "reach"),
    "name": ("name", "by", "dear", "contact", "patient", "llamo", "nombre", "appelle", "nom", "hei\u00dfe", "von", "par", "por"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta", "transfer"),
    "birth": ("born", "birth", "dob", "geboren", "geburt", "n\u00e9 ", "n\u00e9e", "naissance", "nacid", "nacimiento"),
    "national": ("phone", "call", "tel", "mobile", "cell", "fax", "rufen", "handy", "appel", "llam", "m\u00f3vil"),
    "street": ("address", "live", "lives", "adresse", "wohn", "habite", "vive", "vivo", "direcci", "ship", "send"),
}
LABELERS = ("strict", "valid", "gazetteer", "context", "isolated")
#: Values of each feature: the word before, the shape, what follows, the place.
FEATURES = (32, 16, 4, 2)
BEFORE = 40


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = int(c) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of ``[A-Za-z0-9._%+-]+@`` and DOMAIN, in linear time.

    The part before an @ can't hold one, so each match starts where the run of its characters before an @ starts, but not
    before the end of the last match.
    """
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL_PART:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def candidates(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of the base spans, then of the looser candidates that no base span covers."""
    base = []
    base += [(0, start, end) for start, end in emails(text)]
    base += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            base.append((2, m.start(), m.end()))
    if "+" in text:
        base += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    yield from base
    loose = []
    if "-" in text:
        loose += [(4, m.start(), m.end()) for m in SSN.finditer(text)]
    if "(" in text:
        loose += [(5, m.start(), m.end()) for m in LOCAL.finditer(text)]
    if "at)" in text or "at]" in text:
        loose += [(6, m.start(), m.end()) for m in SPELLED.finditer(text)]
    if any(t in text for t in ("Mr", "Ms", "Dr", "Prof", "Herr", "Frau", "Mme", "Sr")):
        loose += [(7, m.start(), m.end()) for m in TITLED.finditer(text) if not text[max(0, m.start() - 1):m.start()].isalnum()]
    titled = {x for k, *span in loose if k == 7 for x in range(*span)}
    loose += [(7, m.start(1), m.end(1)) for m in INTRODUCED.finditer(text) if m.start(1) not in titled]
    accounts = [(8, m.start(), m.end()) for m in IBAN.finditer(text) if _checks_out(m.group())]
    loose += accounts + _uncovered([(10, m.start(), m.end()) for m in NATIONAL.finditer(text)], accounts)
    for kind, pattern in ((9, DATE), (11, STREET)):
        loose += [(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    yield from _uncovered(loose, base)


def _uncovered(spans: list[tuple[int, int, int]], taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans that overlap none of ``taken``, by start; one pass over both."""
    taken, free, at, reach = sorted(taken, key=lambda c: c[1]), [], 0, 0
    for kind, start, end in sorted(spans, key=lambda c: (c[1], c[0])):
        while at < len(taken) and taken[at][1] < end:
            reach, at = max(reach, taken[at][2]), at + 1
        if reach <= start:
            free.append((kind, start, end))
    return free


def votes(text: str, kind: int, start: int, end: int) -> list[int]:
    """Of each labeler: 1 yes, 2 no, 0 nothing to say."""
    name, span = KINDS[kind], text[start:end]
    digits, before = _digits(span), text[max(0, start - BEFORE):start].lower()
    strict = {
        "email": bool(re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9][A-Za-z0-9-]*\.)+[A-Za-z]{2,}", span)), "ip": not re.search(r"(?:^|\.)0[0-9]", span),
        "card": len(digits) in (15, 16) and bool(re.fullmatch(r"[0-9]+|[0-9]{4}(?:([ -])[0-9]{4}(?:\1[0-9]{4}){2}|[ -][0-9]{6}[ -][0-9]{5})", span)),
        "phone": bool(re.fullmatch(r"\+[0-9]{1,3}[ -]?(?:\([0-9]{1,4}\)[ -]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,5}){1,4}", span)), "ssn": True,
        "local": bool(re.fullmatch(r"\([2-9].*", span)), "spelled": "dot" in span, "name": len([w for w in span.split() if w.rstrip(".").lower() not in TITLES]) >= 2,
        "iban": bool(re.fullmatch(r"[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4})+(?: [A-Z0-9]{1,3})?|[A-Z0-9]{15,34}", span)), "birth": bool(re.search("19|200|201", span)),
        "national": 9 <= len(digits) <= 12, "street": any(c.isdigit() for c in span),
    }[name]
    valid = {
        "email": ".." not in span and not span.endswith("-"), "ip": not span.startswith(("0.", "255.")), "card": luhn(digits) and len(set(digits)) > 2,
        "phone": 10 <= len(digits) <= 13, "ssn": digits[:3] not in ("000", "666") and digits[:1] != "9" and digits[3:5] != "00" and digits[5:] != "0000",
        "local": len(digits) == 10, "spelled": True, "name": len(span) >= 6,
        "iban": True, "birth": name == "birth" and _is_day(span), "national": len(set(digits)) > 2 and not re.search("([0-9])\\1{4}", digits), "street": None,
    }[name]
    known = {
        "email": span.rpartition(".")[2].lower() in TOP_LEVEL, "ip": None, "card": digits.startswith(ISSUERS), "phone": digits.startswith(COUNTRY_CODES),
        "ssn": None, "local": None, "spelled": re.split("[^a-z]+", span.lower())[-1] in TOP_LEVEL, "name": True if any(w in GIVEN_NAMES for w in span.lower().split()) else None,
        "iban": None, "birth": None, "national": None, "street": True if any(w in span.lower() for w in STREET_WORDS) else None,
    }[name]
    context = True if any(w in before for w in CONTEXT[name]) else False if name == "birth" else None  # a date alone is nobody's
    around = text[max(0, start - 1):start] + text[end:end + 1]
    isolated = not any(c.isalnum() or c in "_/=" for c in around)
    return [{True: 1, False: 2, None: 0}[v] for v in (strict, valid, known, context, isolated)]


def _checks_out(iban: str) -> bool:
    moved = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in moved[4:] + moved[:4])) % 97 == 1


def _is_day(span: str) -> bool:
    a, b, c = (int(x) for x in re.split("[./-]", span))
    day, month = (c, b) if a > 31 else (a, b)
    return 1 <= day <= 31 and 1 <= month <= 12 or 1 <= month <= 31 and 1 <= day <= 12


def features(text: str, start: int, end: int) -> int:
    """Word before (hashed), shape (hashed), what follows, whether near the text's start; none of them a labeler's. One number, see FEATURES."""
    words = re.findall(r"[^\W\d_]+", text[max(0, start - BEFORE):start].lower())
    word = 1 + zlib.crc32(words[-1].encode("utf-8", "surrogatepass")) % (FEATURES[0] - 1) if words else 0
    form = re.sub("a+", "a", re.sub("A+", "A", re.sub("9+", "9", "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in text[start:end]))))
    after = text[end:end + 1]
    follows = 0 if not after else 1 if after.isspace() else 2 if not after.isalnum() else 3
    return ((word * FEATURES[1] + zlib.crc32(form.encode("utf-8", "surrogatepass")) % FEATURES[1]) * FEATURES[2] + follows) * FEATURES[3] + (start < 200)


SPAN = "struct<kind:int,start:int,end:int,votes:int,features:int>"


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            spans = []
            for text in frame["text"]:
                own = []
                for kind, start, end in candidates(text) if isinstance(text, str) else ():
                    vote = votes(text, kind, start, end)
                    own.append({"kind": kind, "start": start, "end": end, "votes": sum(v * 3**n for n, v in enumerate(vote)), "features": features(text, start, end)})
                spans.append(own)
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "spans": spans})

    return for_workers(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(run, f"doc_id long, spans array<{SPAN}>")


def reliabilities(kind: np.ndarray, vote: np.ndarray, n: np.ndarray, steps: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """EM over counted combinations: kind [c], vote [c, labeler] (0, 1, 2), n [c]. Two latent classes.

    (probability of each combination, yes rate of each labeler [class, labeler], rate of each kind). Starts from the majority of the votes, and
    has a beta prior at that, so that a labeler that never speaks keeps a neutral reliability.
    """
    yes, spoken = vote == 1, vote > 0
    p = np.clip((yes.sum(axis=1) + 1) / (spoken.sum(axis=1) + 2), 0.05, 0.95)
    rate, prior = np.full((2, vote.shape[1]), 0.5), np.full(len(KINDS), 0.5)
    for _ in range(steps):
        for c, w in ((0, n * (1 - p)), (1, n * p)):
            start = (1.0, 3.0) if c == 0 else (3.0, 1.0)
            rate[c] = ((w[:, None] * yes).sum(axis=0) + start[0]) / ((w[:, None] * spoken).sum(axis=0) + sum(start))
        for k in range(len(KINDS)):
            own = kind == k
            prior[k] = ((n * p)[own].sum() + 1) / (n[own].sum() + 2)
        like = np.stack([np.where(spoken, np.where(yes, np.log(rate[c]), np.log(1 - rate[c])), 0.0).sum(axis=1) for c in (0, 1)])
        odds = like[1] - like[0] + np.log(prior[kind] / (1 - prior[kind]))
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return p, rate, prior


def _places(bits: np.ndarray) -> list[np.ndarray]:
    """The features' values, each counted on from the last one's, as places in a vector of weights after the intercept."""
    out, first = [], 1 + sum(FEATURES)
    for size in reversed(FEATURES):
        first -= size
        out.append(first + bits % size)
        bits = bits // size
    return out


def train(bits: np.ndarray, n: np.ndarray, target: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Logistic regression of one kind by Newton's method, over counted features: the intercept and a weight for each value of each feature."""
    x = np.zeros((len(bits), 1 + sum(FEATURES)))
    x[:, 0] = 1
    for at in _places(bits):
        x[np.arange(len(bits)), at] = 1
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(hessian, x.T @ (n * (target - p)) - ridge * w), -2, 2)
    return w


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, findings array<struct<kind, start, end, probability>>."""
    found = cut(_found(docs, id_col, text_col))
    each = found.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.features")
    # At most kinds x 3 ** labelers rows, whatever the input.
    seen = each.groupBy("kind", "votes").count().toPandas().sort_values(["kind", "votes"])
    odds = np.zeros((len(KINDS), 3 ** len(LABELERS)))
    for k, own in seen.groupby("kind"):
        votes_seen = own["votes"].to_numpy(np.int64)
        vote = votes_seen[:, None] // 3 ** np.arange(len(LABELERS)) % 3
        p, _, _ = reliabilities(np.zeros(len(own), np.int64), vote, own["count"].to_numpy(float))
        p = np.clip(p, 1e-4, 1 - 1e-4)
        odds[k, votes_seen] = np.log(p / (1 - p))
    # At most kinds x the product of FEATURES rows (49,152).
    target = 1 / (1 + F.exp(-_weight(odds, F.col("kind"), F.col("votes"))))
    counted = each.groupBy("kind", "features").agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("target")).toPandas().sort_values(["kind", "features"])
    weights = np.zeros((len(KINDS), 1 + sum(FEATURES)))
    for k, own in counted.groupby("kind"):
        weights[k] = train(own["features"].to_numpy(np.int64), own["n"].to_numpy(float), own["target"].to_numpy(float))
    return _listed(found, odds, weights, least)


def _weight(table: np.ndarray, kind: Column, place: Column) -> Column:
    """table[kind, place]: a list of lists whose size is fixed by KINDS, LABELERS and FEATURES, never by the data."""
    values = F.from_json(F.lit(json.dumps([[round(float(x), 6) for x in row] for row in table])), "array<array<double>>")
    return F.get(F.get(values, kind), place)


def _classified(weights: np.ndarray, kind: Column, bits: Column) -> Column:
    score, first = _weight(weights, kind, F.lit(0)), 1 + sum(FEATURES)
    for size in reversed(FEATURES):
        first -= size
        score = score + _weight(weights, kind, (F.lit(first) + bits % size).cast("int"))
        bits = F.floor(bits / size)
    return score


def _listed(found: DataFrame, odds: np.ndarray, weights: np.ndarray, least: float) -> DataFrame:
    probability = lambda s: F.round(1 / (1 + F.exp(-(_weight(odds, s["kind"], s["votes"]) + _classified(weights, s["kind"], s["features"])) / 2)), 6)
    names = F.array(*[F.lit(k) for k in KINDS])
    judged = F.array_sort(F.transform("spans", lambda s: F.struct(
        s["kind"].alias("no"), s["start"].alias("start"), s["end"].alias("end"), probability(s).alias("probability"))))
    kept = found.select("doc_id", F.filter(judged, lambda s: (s["no"] < BASE_KINDS) | (s["probability"] >= least)).alias("kept"))
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.get(names, s["no"]), s["start"], s["end"])), ",")
    n_kind = lambda k: F.size(F.filter("kept", lambda s: s["no"] == k))
    return kept.select(
        "doc_id", *[n_kind(k).cast("long").alias(f"n_{KINDS[k]}") for k in range(BASE_KINDS)],
        F.sha2(listed(F.filter("kept", lambda s: s["no"] < BASE_KINDS)), 256).alias("base_sha256"), listed("kept").alias("spans"),
        F.transform("kept", lambda s: F.struct(F.get(names, s["no"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["probability"].alias("probability"))).alias("findings"))

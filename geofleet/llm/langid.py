"""Operator 4: language identification by multilingual mixture inference.

A document is a mixture of languages: each of its character trigrams comes from language l with probability share_l, and
then has likelihood P(trigram | l). The trigram likelihoods are counted by Spark over a bounded sample of labelled rows
outside the held-out fold (``max_train`` rows of least id hash). For every document expectation-maximisation
estimates the shares, over its best language alone, its best two, and so on up to all of them; the set of
languages is the one of greatest penalised likelihood (half the log of the sample size for every further share). A document
leaves the search where the likelihood's upper bound, less the penalty, shows that no wider set can be better. The
prediction is the language of the largest share, the score that share.

Inference is one map over the rows, in chunks of bounded size, without a shuffle. Whole texts are read.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text if no labelled row
can be learned from; ties go to the language first by name; repeated rows get the same result; null ids are never held out nor learned from; null
lang isn't learned; extra columns are ignored; empty input gives no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geofleet.llm.common import cut, for_workers
from geofleet.llm.sampling import bounded_sample, held_out

MAX_TRAIN = 20_000
BUCKETS = 1 << 15
SMOOTH = 0.5
CHUNK_CHARS = 400_000
UNKNOWN = "und"
#: Overlapping trigrams repeat each other's letters: three count as one observation.
OVERLAP = 3.0


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, trigram bucket, count) of the texts' distinct trigrams, ordered by document; whether each text has a letter.

    Characters that aren't letters are blanks; trigrams of a blank in the middle and of no letter are left out.
    """
    lowered = [" " + t.lower() + " " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    letter = _letters()[codes]
    has = np.bincount(doc, weights=letter, minlength=len(texts)) > 0
    plain = np.where(letter, codes, 32).astype(np.uint64)
    mixed = (plain[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ plain[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) + plain[2:] * np.uint64(0x165667B19E3779F9)
    bucket = (mixed * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(49)).astype(np.int64)
    use = letter[1:-1] & (doc[:-2] == doc[2:])
    keys, counts = np.unique(doc[1:-1][use] * BUCKETS + bucket[use], return_counts=True)
    return keys // BUCKETS, keys % BUCKETS, counts.astype(np.float64), has


def chunks(texts: list[str], size: int = CHUNK_CHARS) -> Iterator[list[str]]:
    part, chars = [], 0
    for t in texts:
        part.append(t)
        chars += len(t)
        if chars >= size:
            yield part
            part, chars = [], 0
    if part:
        yield part


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_train: int = MAX_TRAIN) -> tuple[list[str], np.ndarray]:
    """(languages, log likelihoods [trigram bucket, language])."""
    known = for_workers(docs).select(F.col(id_col).alias("_id"), F.col(lang_col).alias("lang")).where("_id is not null and lang is not null").where(~held_out(F.col("_id")))
    chosen = cut(bounded_sample(known.select("_id").distinct(), "_id", max_train))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lang, own in frame.groupby("lang"):
                total = np.zeros(BUCKETS)
                for part in chunks([t for t in own["text"] if isinstance(t, str)]):
                    _, bucket, n, _ = trigrams(part)
                    np.add.at(total, bucket, n)
                at = np.flatnonzero(total)
                yield pd.DataFrame({"lang": lang, "bucket": at, "n": total[at].astype(np.int64)})

    # A bounded sample of ids: it is broadcast, so the texts aren't shuffled.
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null").join(F.broadcast(chosen), "_id")
    counts = rows.select("lang", "text").mapInPandas(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(counts["lang"].unique())
    n = np.zeros((BUCKETS, len(names)))
    n[counts["bucket"], [names.index(x) for x in counts["lang"]]] = counts["n"]
    return names, np.log((n + SMOOTH) / (n.sum(axis=0) + SMOOTH * BUCKETS))


def _em(doc: np.ndarray, n: np.ndarray, p: np.ndarray, size: np.ndarray, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Shares [document, k] and log likelihood of each document; p[entry, k] are its entries' likelihoods."""
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    at = np.searchsorted(doc[first], doc)
    share = np.full((len(first), p.shape[1]), 1.0 / p.shape[1])
    for _ in range(steps):
        joint = share[at] * p
        joint *= (n / joint.sum(axis=1))[:, None]
        share = np.add.reduceat(joint, first, axis=0) / size[first][:, None]
    return share, np.add.reduceat(n * np.log((share[at] * p).sum(axis=1)), first)


def infer(texts: list[str], names: list[str], logp: np.ndarray) -> list[tuple[str, float, list[tuple[str, float]]]]:
    """(language, score, [(language, share)]) of each text."""
    if not names:
        return [(UNKNOWN, 0.0, [])] * len(texts)
    doc, bucket, n, has = trigrams(texts)
    out: list = [(UNKNOWN, 0.0, [])] * len(texts)
    if not len(doc):
        return [(names[0], 1.0 / len(names), []) if h else o for h, o in zip(has, out, strict=True)]
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    present = doc[first]
    at = np.searchsorted(present, doc)
    size = np.add.reduceat(n, first)[at]
    single = np.add.reduceat(n[:, None] * logp[bucket], first, axis=0)
    p = np.exp(logp[bucket])
    full, reached = _em(doc, n, p, size)
    # The likelihood is concave in the shares, so its slope at ``full`` bounds it for every set of languages.
    slope = np.add.reduceat(p * (n / (full[at] * p).sum(axis=1))[:, None], first, axis=0).max(axis=1)
    bound = (reached + slope - size[first]) / OVERLAP
    merit = np.round(full, 9)
    np.put_along_axis(merit, np.argmax(single, axis=1)[:, None], 2.0, axis=1)  # the best alone comes first, then by share
    ranked = np.argsort(-merit, axis=1, kind="stable")
    observed = size[first] / OVERLAP
    best = np.take_along_axis(single, ranked[:, :1], axis=1)[:, 0] / OVERLAP
    shares = np.zeros_like(full)
    np.put_along_axis(shares, ranked[:, :1], 1.0, axis=1)
    penalty = 0.5 * np.log(np.maximum(observed, 2.0))
    for k in range(2, len(names) + 1):
        open_ = bound - (k - 1) * penalty > best + 1e-9
        if not open_.any():
            break
        rows, entries = np.flatnonzero(open_), open_[at]
        chosen = ranked[rows, :k]
        own = np.searchsorted(rows, at[entries])
        share, fit = _em(own, n[entries], np.take_along_axis(p[entries], chosen[own], axis=1), size[entries])
        fit = fit / OVERLAP - (k - 1) * penalty[rows]
        better = fit > best[rows] + 1e-9
        best[rows[better]] = fit[better]
        wider = np.zeros((len(rows), len(names)))
        np.put_along_axis(wider, chosen, share, axis=1)
        shares[rows[better]] = wider[better]
    for d, s in zip(present, shares, strict=True):
        found = sorted(((names[i], float(s[i])) for i in np.flatnonzero(s > 0)), key=lambda x: (-round(x[1], 9), x[0]))
        out[d] = (found[0][0], min(1.0, found[0][1]), found)
    return [o if h else (UNKNOWN, 0.0, []) for h, o in zip(has, out, strict=True)]


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_train: int = MAX_TRAIN) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, languages array<struct<lang, share>>."""
    names, logp = learn(docs, id_col, text_col, lang_col, max_train)
    model = docs.sparkSession.sparkContext.broadcast((names, logp))  # BUCKETS x languages numbers

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [r for part in chunks([t if isinstance(t, str) else "" for t in frame["text"]]) for r in infer(part, *model.value)]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"].astype("Int64"), "held_out": frame["held_out"], "lang_pred": [r[0] for r in found], "score": [r[1] for r in found],
                "languages": [[{"lang": a, "share": s} for a, s in r[2]] for r in found]})

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return narrow.mapInPandas(run, "doc_id long, held_out boolean, lang_pred string, score double, languages array<struct<lang:string,share:double>>")

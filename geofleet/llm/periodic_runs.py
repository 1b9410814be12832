"""Operator 13: periodic runs of words by seed-and-extend diagonals.

A run is a stretch of words with smallest period q (words q apart are equal), of max(6, 4 q) words or more, that no neighbouring
word extends. Its words agree with those q later on length - q places, so a k-gram of at most that many words at its start
occurs again q later. Lags are taken in classes (q0, q1]: a class indexes the k-grams of the overlap that its least lag
guarantees: k = 5 for lags 1 to 6, then k = 3 (q0 + 1) for lags up to k + 1.

Occurrence pairs: of each k-gram, every occurrence and the next one. That is enough: an occurrence between, d < q words on, would give
the run's first d + k >= d + q - gcd(d, q) words both periods, hence gcd(d, q), and q would not be the smallest. So each class has at most n pairs.
A pair on a lag's diagonal is extended both ways, unless the lag's table of the furthest place covered holds it already.

k-grams are numbered exactly (a pair of shorter grams' numbers), and only where both parts repeat: a text without repeats is
done after its first, shortest grams.

Each text is judged by itself, in its own row; nothing is shuffled. Defined results: a null text has no words; fewer than six words have no
run; ids may be null or repeated; empty input gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geofleet.llm.common import for_workers

LEAST_WORDS = 6
EXPONENT = 4


def _longer(rank: np.ndarray, p: int, k: int) -> np.ndarray:
    """Numbers of k-grams from those of p-grams, p < k <= 2 p; -1 where a gram occurs once."""
    n = len(rank) - (k - p)
    if n <= 0:
        return np.empty(0, np.int64)
    a, b = rank[:n], rank[k - p:k - p + n]
    at = np.flatnonzero((a >= 0) & (b >= 0))
    out = np.full(n, -1, np.int64)
    if len(at):
        _, number, count = np.unique(a[at] * (int(rank.max()) + 1) + b[at], return_inverse=True, return_counts=True)
        out[at] = np.where(count[number] > 1, number, -1)
    return out


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements are equal, read in growing pieces."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = a[at:at + step] != b[at:at + step][:n - at]
        if differ.any():
            return at + int(differ.argmax())
        at, step = min(n, at + step), step * 2
    return n


def _primes(q: int) -> Iterator[int]:
    d = 2
    while d * d <= q:
        if q % d == 0:
            yield d
            while q % d == 0:
                q //= d
        d += 1
    if q > 1:
        yield q


def runs(ids: np.ndarray, least: int = LEAST_WORDS, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in a sequence of numbered words, by start, then period.

    ``exponent`` >= 3: the proof above takes (exponent - 1) q places of overlap.
    """
    n, found = len(ids), []
    count = np.bincount(ids) if n else np.empty(0, np.int64)
    rank, p, q0 = np.where(count[ids] > 1, ids, -1) if n else ids, 1, 0
    while q0 < n // exponent:
        k = max(1, min(max(least, exponent * q) - q for q in range(q0 + 1, q0 + least + 1)))
        while p < k and (rank >= 0).any():
            longer = min(2 * p, k)
            rank, p = _longer(rank, p, longer), longer
        at = np.flatnonzero(rank >= 0)
        if not len(at):
            break
        q1 = k + 1
        order = np.argsort(rank[at], kind="stable")
        first, second = at[order][:-1], at[order][1:]
        lag = second - first
        pick = (rank[first] == rank[second]) & (lag > q0) & (lag <= q1)
        first, lag = first[pick], lag[pick]
        by = np.lexsort((first, lag))
        first, lag = first[by], lag[by]
        head = np.ones(len(first), bool)  # the next word's pair on the same diagonal lies inside the same stretch
        head[1:] = (lag[1:] != lag[:-1]) | (first[1:] != first[:-1] + 1)
        covered: dict[int, int] = {}
        for i, q in zip(first[head].tolist(), lag[head].tolist(), strict=True):
            if i < covered.get(q, 0):
                continue
            end = i + _agree(ids[i:n - q], ids[i + q:])
            start = i - _agree(ids[:i][::-1], ids[q:i + q][::-1])
            covered[q] = end
            length = end - start + q
            if length >= max(least, exponent * q) and not any(
                    np.array_equal(ids[start:start + q - d], ids[start + d:start + q]) for d in (q // x for x in _primes(q))):
                found.append((start, length, q))
        q0 = q1
    return sorted(found, key=lambda r: (r[0], r[2]))


def numbered(parts: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in parts), np.int64, len(parts))


def collapse(parts: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not found:
        return parts
    keep = np.ones(len(parts), bool)
    for start, length, period in found:
        keep[start + period:start + length] = False
    return [parts[i] for i in np.flatnonzero(keep).tolist()]


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS, exponent: int = EXPONENT) -> DataFrame:
    """One row per row of ``df``: doc_id, n_words, runs array<struct<start, length, period>> by start, then period, and
    collapsed: the text's words without the runs' repeats, joined by one space."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [(t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"").split() for t in frame["text"]]
            found = [runs(numbered(parts), least, exponent) if len(parts) >= least else [] for parts in texts]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"].astype("Int64"), "n_words": [len(parts) for parts in texts],
                "runs": [[{"start": s, "length": n, "period": q} for s, n, q in f] for f in found],
                "collapsed": [b" ".join(collapse(p, f)).decode("utf-8", "surrogatepass") for p, f in zip(texts, found, strict=True)]})

    narrow = for_workers(df).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInPandas(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")

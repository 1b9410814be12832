"""Operator 5: toxicity by gradient-boosted trees over dense features, with isotonic calibration.

1. Sample: at most ``max_train`` labelled rows outside the held-out fold, by least hash of the id, in three parts:
   for the lexicon, the trees and the calibration, so that neither later step trusts what an earlier one has fitted.
2. Lexicon: words and word stems (the first 4 to 6 letters) that many more toxic texts hold than others, counted by
   Spark over the first part, beside a short fixed list.
3. Features of a whole text: densities of lexicon terms, their proximity to the second person, capitals, punctuation,
   obfuscation (marks and digits inside words, and terms found once these are undone). One pass of an automaton.
4. Spark ML's gradient-boosted trees on the second part; isotonic regression of the label on their probability on the third.

Scoring is one map over the rows: no shuffle. Learning costs the same at every size, beyond finding the sample.

Defined results: a null text counts as empty and is scored like any other; repeated rows are scored alike; a null id is never held out
nor learned from; several labels of one document: the largest counts; without labels of both kinds the score is the only label
there is, or 0; extra columns are ignored by ``score`` and kept by ``drop_toxic``; empty input gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geofleet.llm.common import cut, for_workers, row_struct
from geofleet.llm.sampling import bounded_sample, held_out

MAX_TRAIN = 20_000
MAX_TERMS = 2_000
STEMS = (4, 5, 6)
#: Common insults, as a start for small samples.
INSULTS = ("idiot moron stupid dumb loser trash garbage scum worthless pathetic disgusting clown fool filthy ugly "
           "imbecile jerk bastard vermin").split()
#: Second person in the languages at hand.
SECOND_PERSON = set("you your yours yourself ur tu te toi ton vous votre vos du dich dir dein deine euch ihr tú ti usted ustedes".split())
_WORD = re.compile(r"[^\W\d_]+")
_SHOUT = re.compile(r"(?<![A-Z])[A-Z]{3,}")
_INSIDE = re.compile(r"[@$*#!|0-9](?<=[^\W\d_].)(?=[^\W\d_])")
_MARKS_RUN = re.compile(r"[!?]{2,}")
_LEET = str.maketrans("013457@$!|", "oieastasil")
_DROPPED = str.maketrans("", "", "*#")
NEAR = 60
FEATURES = ("log_hits", "density", "distinct", "near_second_person", "closest", "undone_hits", "obfuscated", "capitals",
            "shouted", "punctuation", "exclaimed", "marks_runs", "digits", "log_words")


@dataclass
class Lexicon:
    """Whole words, and stems that a word may begin with."""

    words: set[str]
    stems: set[str]
    automaton: object = field(default=None, repr=False)

    def __post_init__(self):
        self.automaton = ahocorasick.Automaton()
        for term in self.words | self.stems:
            self.automaton.add_word(term, len(term))
        if self.words or self.stems:
            self.automaton.make_automaton()

    def __getstate__(self):
        return {"words": self.words, "stems": self.stems}

    def __setstate__(self, state):
        self.__init__(**state)

    def find(self, text: str) -> list[tuple[int, int]]:
        """(start, end) of each word of the lower-cased text that is a term or begins with a stem."""
        found: dict[int, int] = {}
        if not (self.words or self.stems):
            return []
        for last, size in self.automaton.iter(text):
            start = last - size + 1
            if start in found or start and text[start - 1].isalpha():
                continue
            whole = last + 1 == len(text) or not text[last + 1].isalpha()
            term = text[start:last + 1]
            if term in self.stems or whole and term in self.words:
                found[start] = last + 1
        return list(found.items())


def text_features(text: str, lexicon: Lexicon) -> list[float]:
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    letters = max(1, raw[65:91].sum() + raw[97:123].sum() + raw[195:].sum())
    chars, words = max(1, len(text)), max(1, raw[32] + raw[10] + raw[9] + 1)
    low = text.lower()
    hits = lexicon.find(low)
    closest, near = NEAR * 4, 0
    for start, end in hits:
        least = NEAR * 4
        for m in _WORD.finditer(low, max(0, start - NEAR * 4), min(len(low), end + NEAR * 4)):
            if m.group() in SECOND_PERSON:
                least = min(least, max(0, m.start() - end, start - m.end()))
        closest, near = min(closest, least), near + (least <= NEAR)
    inside = sum(1 for _ in _INSIDE.finditer(low))
    undone = max(0, len(lexicon.find(low.translate(_DROPPED).translate(_LEET))) - len(hits)) if inside else 0
    return [
        float(np.log1p(len(hits))), 100.0 * len(hits) / words, float(len({low[s:e] for s, e in hits})), float(near), float(closest),
        float(undone), 100.0 * inside / words, float(raw[65:91].sum() / letters), 100.0 * sum(1 for _ in _SHOUT.finditer(text)) / words,
        float((raw[33:48].sum() + raw[58:65].sum() + raw[91:97].sum() + raw[123:127].sum()) / chars), float(raw[33] / chars),
        100.0 * sum(1 for _ in _MARKS_RUN.finditer(text)) / words, float(raw[48:58].sum() / chars), float(np.log1p(words)),
    ]


def features(lexicon: Lexicon) -> Callable[[Column], Column]:
    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([text_features(t if isinstance(t, str) else "", lexicon) for t in texts])

    return of


def learn_lexicon(rows: DataFrame, max_terms: int = MAX_TERMS, least_texts: int = 4, least_ratio: float = 20.0) -> Lexicon:
    """Terms from rows(text, label): ``least_texts`` toxic texts at least hold them, and at ``least_ratio`` times the rate of others."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen = (Counter(), Counter())
            for text, label in zip(frame["text"], frame["label"], strict=True):
                words = set(_WORD.findall((text if isinstance(text, str) else "").lower()))
                units = {"=" + w for w in words} | {w[:n] for n in STEMS for w in words if len(w) > n}
                seen[int(label)].update(units)
            both = list(seen[0].keys() | seen[1].keys())
            yield pd.DataFrame({"unit": both, "toxic": [seen[1][u] for u in both], "clean": [seen[0][u] for u in both]})

    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, clean = max(1, sizes.get(1, 0)), max(1, sizes.get(0, 0))
    counted = rows.mapInPandas(run, "unit string, toxic long, clean long").groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    ratio = (F.col("toxic") / toxic) / ((F.col("clean") + 0.5) / clean)
    top = counted.where((F.col("toxic") >= least_texts) & (ratio >= least_ratio)).orderBy(F.desc("toxic"), "unit").limit(max_terms).collect()
    units = [r["unit"] for r in top]
    return Lexicon({u[1:] for u in units if u[0] == "="} | set(INSULTS), {u for u in units if u[0] != "="})


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: object
    constant: float = 0.0

    def score(self, df: DataFrame, text_col: str, out: str) -> DataFrame:
        """``df`` with the score as column ``out``; df has no columns that begin with _tox_, and none called probability or rawPrediction."""
        if self.trees is None:
            return df.withColumn(out, F.lit(self.constant))
        with_features = df.withColumn("_tox_features", array_to_vector(features(self.lexicon)(F.col(text_col))))
        raw = self.trees.transform(with_features).withColumn("_tox_raw", vector_to_array("probability")[1])
        scored = self.calibration.transform(raw).withColumnRenamed("_tox_score", out) if self.calibration else raw.withColumn(out, F.col("_tox_raw"))
        return scored.select(*df.columns, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col(out))).alias(out))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_train: int = MAX_TRAIN) -> ToxicityModel:
    known = (for_workers(labels).where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(F.when(F.col(label_col) >= 1, 1).otherwise(0)).alias("label")))
    chosen = cut(bounded_sample(known, "_id", max_train))
    # A bounded sample of ids: it is broadcast, so the texts aren't shuffled.
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "_id")
    sample = cut(rows.withColumn("part", F.pmod(F.hash(F.col("_id"), F.lit("part")), F.lit(10))).repartition(12, "_id"))
    lexicon = learn_lexicon(sample.where("part < 4").select("text", "label"))
    seen = cut(sample.where("part >= 4").select("part", F.col("label").cast("double"), features(lexicon)("text").alias("f")))
    data = seen.select("part", "label", array_to_vector("f").alias("_tox_features"))
    kinds = {(r["cal"], r["label"]) for r in data.select((F.col("part") >= 8).alias("cal"), "label").distinct().collect()}
    if {(False, 0.0), (False, 1.0)} - kinds:
        only = {k[1] for k in kinds}
        return ToxicityModel(lexicon, None, None, only.pop() if len(only) == 1 else 0.0)
    gbt = GBTClassifier(featuresCol="_tox_features", labelCol="label", predictionCol="_tox_class",
                        maxIter=20, maxDepth=4, stepSize=0.2, seed=7)
    trees = gbt.fit(data.where("part < 8").coalesce(6))
    calibration = None
    if not {(True, 0.0), (True, 1.0)} - kinds:
        at = trees.transform(data.where("part >= 8")).select("label", vector_to_array("probability")[1].alias("_tox_raw"))
        calibration = IsotonicRegression(featuresCol="_tox_raw", labelCol="label", predictionCol="_tox_score").fit(at)
    return ToxicityModel(lexicon, trees, calibration)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, id_col, text_col, max_train=max_train)
    narrow = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return (model.score(narrow, "text", "score").select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of ``docs`` that score below 0.5; all columns."""
    model = fit(docs, labels, id_col, text_col, max_train=max_train)
    packed = docs.select(row_struct(docs).alias("row"), F.col(text_col).alias("text"))
    return model.score(packed, "text", "score").where("score < 0.5").select("row.*")

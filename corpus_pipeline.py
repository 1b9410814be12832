"""Corpus pipeline: from documents to packed training sequences.

Each stage takes all that its predecessor kept. Its result is written as Parquet and read again, so a lost executor
costs at most the running stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geofleet.llm import exact_dedup, mixing, packing, simhash, toxicity
from geofleet.llm.common import table
from geofleet.llm.queries import tokenizer_path
from geofleet.session import scratch_path
from geofleet.sources.files import delete_folders


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents scoring 0.5 or more go. Learns from ``labels`` of the documents at hand."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of equal texts the document of the largest id stays."""
    return exact_dedup.drop_duplicates_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each group of linked fingerprints the document of the smallest id stays."""
    return simhash.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: all documents, in the files' order of the mix to smoothed source weights."""
    return mixing.in_mixed_order(docs, mixing.smoothed_weights(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: the pieces of every document in sequences of at most 4096 tokens, numbered in the order of the mix."""
    return packing.pack_in_order(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Not expressible in SQL (a learned classifier, XXH64, a tokenizer); tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed pieces. A stage's table goes once the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        delete_folders(spark, before)
        before = [path]
    return docs

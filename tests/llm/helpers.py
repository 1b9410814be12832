from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, rows: list[tuple], extra: str = "") -> DataFrame:
    """rows: (doc_id, text[, source[, lang]])."""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    for c in extra.split():
        df = df.selectExpr("*", f"concat('x', doc_id) as `{c}`")
    return df


def by_id(df: DataFrame, key: str = "doc_id") -> dict:
    return {r[key]: r.asDict() for r in df.collect()}

"""Declarative data-quality checks.

A check returns the number of failing rows/groups; zero means pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from geofleet import constants as K


@dataclass(frozen=True)
class Check:
    kind: str                      # not_null | unique | accepted_values | unique_combination
    model: str
    columns: tuple[str, ...]
    values: tuple[str, ...] = field(default=())

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)


# The nine checks declared on the silver and gold models.
DEFAULT_CHECKS: tuple[Check, ...] = (
    Check("unique", "iot_validated", ("event_id",)),
    Check("not_null", "iot_validated", ("event_id",)),
    Check("not_null", "iot_validated", ("device_id",)),
    Check("not_null", "iot_validated", ("event_ts",)),
    Check("accepted_values", "iot_validated", ("severity",), K.SEVERITY_VALUES),
    Check("not_null", "device_daily", ("device_id",)),
    Check("not_null", "device_daily", ("event_date",)),
    Check("not_null", "device_daily", ("event_count",)),
    Check("unique_combination", "device_daily", ("device_id", "event_date")),
)


def _null(col: str):
    return F.col(col).isNull()


def _table_pass(df: DataFrame, model: str, checks: list[Check]) -> DataFrame:
    """All not_null and accepted_values checks of one table in one aggregate over it."""
    def failures(c: Check):
        col = F.col(c.columns[0])
        if c.kind == "not_null":
            return F.count_if(_null(c.columns[0]))
        return F.count_distinct(F.when(col.isNotNull() & ~col.isin(*c.values), col))

    counts = df.agg(*[failures(c).alias(f"_f{i}") for i, c in enumerate(checks)])
    stacked = ", ".join(f"'{c.kind}', '{c.column_name}', _f{i}" for i, c in enumerate(checks))
    return counts.selectExpr(f"stack({len(checks)}, {stacked}) as (check_name, column_name, failures)").select(
        "check_name", F.lit(model).alias("model"), "column_name", "failures")


def observed(df: DataFrame, model: str, checks: tuple[Check, ...] = DEFAULT_CHECKS) -> tuple[DataFrame, Observation]:
    """``df`` that counts its own column checks' failing rows while it is written, without a scan of their own.

    To be put last before the write, in the stage whose tasks count once each, and not below a shuffle: sampling for a range
    partitioning runs what is below it twice.
    """
    metrics = Observation()
    own = _column_checks(checks, model)
    bad = [F.count_if(_null(c.columns[0]) if c.kind == "not_null" else ~F.col(c.columns[0]).isin(*c.values)).alias(f"f{i}") for i, c in enumerate(own)]
    return (df.observe(metrics, *bad) if bad else df), metrics


def _column_checks(checks: tuple[Check, ...], model: str) -> list[Check]:
    return [c for c in checks if c.model == model and c.kind in ("not_null", "accepted_values")]


def checks_after_write(spark: SparkSession, tables: dict[str, DataFrame], metrics: dict[str, Observation], checks: tuple[Check, ...] = DEFAULT_CHECKS) -> DataFrame:
    """What ``run_checks`` gives, with the column checks taken from the write's own counts. Keys that must be unique are grouped as ever;
    a list of accepted values is scanned again only if the write met others, to say how many."""
    known, left = [], []
    for c in checks:
        own = _column_checks(checks, c.model)
        rows = metrics[c.model].get[f"f{own.index(c)}"] if c in own else None
        if rows is None or (rows and c.kind == "accepted_values"):
            left.append(c)
        else:
            known.append((c.kind, c.model, c.column_name, rows))
    counted = spark.createDataFrame(known, "check_name STRING, model STRING, column_name STRING, failures BIGINT")  # a row per check
    return counted.unionByName(run_checks(tables, tuple(left))) if left else counted


def _grouped_pass(df: DataFrame, c: Check) -> DataFrame:
    """Groups of equal key with more than one row. ``unique`` skips null keys, a combination counts them."""
    rows = df.select(*c.columns)
    if c.kind == "unique":
        rows = rows.where(~_null(c.columns[0]))
    groups = rows.groupBy(*c.columns).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return groups.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(c.kind).alias("check_name"), F.lit(c.model).alias("model"), F.lit(c.column_name).alias("column_name"), "failures")


def run_checks(tables: dict[str, DataFrame], checks: tuple[Check, ...] = DEFAULT_CHECKS) -> DataFrame:
    """One row per check: (check_name, model, column_name, failures).

    A table is read once for all its column checks, and once for each key that must be unique.
    """
    parts: list[DataFrame] = []
    for model in dict.fromkeys(c.model for c in checks):
        own = [c for c in checks if c.model == model]
        if columns := [c for c in own if c.kind in ("not_null", "accepted_values")]:
            parts.append(_table_pass(tables[model], model, columns))
        for c in own:
            if c.kind in ("unique", "unique_combination"):
                parts.append(_grouped_pass(tables[model], c))
            elif c not in columns:
                raise ValueError(f"unknown check kind {c.kind!r}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("check_name", "model", "column_name", F.col("failures").cast("bigint").alias("failures"))


def failing(results: DataFrame) -> DataFrame:
    return results.where(F.col("failures") > 0)

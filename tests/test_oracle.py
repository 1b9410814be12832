"""Every registered device-data query against its DuckDB oracle on the smallest fixture."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from geofleet.plans import catalog
from tests.compare import matches_oracle, views
from tests.conftest import SF_SMALL

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return views(SF_SMALL, "events")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    assert name in SQL, f"{name} has no oracle"
    matches_oracle(spark, duck, E.queries()[name], SQL[name], SF_SMALL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "event_count" in df.columns

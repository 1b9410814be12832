"""The training-data queries that have SQL against it; the others have tests of their own."""

from __future__ import annotations

import pytest

from geofleet.llm import queries as Q
from tests.compare import matches_oracle, views
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def duck():
    return views(SF_SMALL, "documents", "pages", "embeddings", "benchmark", "conversations")


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_matches_oracle(spark, duck, name):
    matches_oracle(spark, duck, Q.QUERIES[name], Q.SQL[name], SF_SMALL)

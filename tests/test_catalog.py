"""Every catalog query with SQL text against DuckDB on the whole test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from compare import connect, differences
from riskweave.catalog.oracle import all_oracles
from riskweave.catalog.queries import all_queries

# The corpus operators have tests of their own.
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_duckdb(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


# Outputs of fitted models; tests/test_models.py holds them against a fit of its own.
WITHOUT_SQL = {"model_eval", "stream_model_score"}


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) - WITHOUT_SQL == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = entry_points.entry(spark), entry_points.entry(spark)
    assert first.schema == second.schema
    assert first.count() == 1000

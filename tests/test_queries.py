"""Every registered query equals its reference SQL on the smallest data folder."""

from __future__ import annotations

import pytest
from check_queries import compare, database
from conftest import SF_DIR

import __spark_entry__ as entry
from tidemark.plans.oracle import ORACLE
from tidemark.plans.queries import QUERIES

# Fitted models have no SQL twin; they are tested in test_training and by check_queries.
MODELS = {"model_scores", "model_coefficients", "model_baseline", "grid_search"}
# The corpus operators have tests of their own.
NAMES = sorted(set(QUERIES) - MODELS)


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_only_models_go_without_sql():
    assert set(QUERIES) - set(ORACLE) == MODELS
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()

"""Every registered query against its DuckDB twin (row count, columns, types and
values), at sf0.001 here; the driver repeats this at sf0.01."""

import os
import sys

import pytest

from paths import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import compare  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from loamline.plans.catalog import QUERIES  # noqa: E402
from loamline.plans.oracle import ORACLE  # noqa: E402

NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF_SMALL)


# Iterative or randomised model queries: rows-only checks by the driver,
# value checks in test_models.py.
ROWS_ONLY = {"least_squares_fit", "fitted_model_comparison", "boosted_regression", "classifier_reports", "fertility_scoring"}


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, n, _, msg = compare.compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert ok, msg
    assert n >= 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["station_id", "event_id"]
    assert df.count() > 0

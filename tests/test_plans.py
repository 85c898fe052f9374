"""Plan properties the design relies on (see README, "Design for scale")."""

import re

import pytest

from loamline.plans.catalog import QUERIES

from paths import SF_SMALL

ROWS_ONLY_MODELS = {"least_squares_fit", "online_epoch", "sgd_fit", "learning_rate_sweep", "fitted_model_comparison",
                    "boosted_regression", "classifier_reports", "fertility_scoring"}


def _plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_prunes_columns_and_shuffles_by_station_bucket(spark):
    plan = _plan(spark, "moisture_features")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("event_type" not in s for s in schemas)
    assert re.search(r"hashpartitioning\(station_id#\d+L, _sx_bucket#\d+L", plan)


def test_top_k_and_latest_are_partial(spark):
    assert plan_has(_plan(spark, "last_n_completed"), "WindowGroupLimit")
    assert plan_has(_plan(spark, "latest_reading"), "partial_max_by")


def plan_has(plan, word):
    return word in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ROWS_ONLY_MODELS))
def test_no_cross_or_nested_loop_joins(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python UDFs


def test_sql_flagship_shuffles_by_station_bucket(spark):
    plan = _plan(spark, "moisture_features_sql")
    assert re.search(r"hashpartitioning\(station_id#\d+L, bkt#\d+", plan)

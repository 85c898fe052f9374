
import pytest
from pyspark.sql import functions as F

from loamline.functions import scalar
from loamline.operators import metrics, quality


def test_round_half_even_matches_numpy(spark):
    # NumPy round(2) results for the half-way probes.
    cases = [(1.005, 1.0), (1.015, 1.01), (2.675, 2.68), (0.285, 0.28),
             (1.115, 1.12), (0.125, 0.12), (22.555, 22.56)]
    df = spark.createDataFrame([(x,) for x, _ in cases], "x double")
    got = [r[0] for r in df.select(scalar.round_half_even("x")).collect()]
    assert got == [y for _, y in cases]


def test_float32_widening(spark):
    v = spark.range(1).select(scalar.float32(F.lit(0.1))).first()[0]
    assert v == 0.10000000149011612


def test_text_to_number(spark):
    df = spark.createDataFrame([("abc",), ("0.5",), (None,)], "t string")
    assert [r[0] for r in df.select(scalar.to_number("t")).collect()] == [None, 0.5, None]


def test_hour_encoding_hour6(spark):
    row = spark.range(1).select(scalar.hour_sin(F.lit(6)), scalar.hour_cos(F.lit(6))).first()
    assert abs(row[0] - 1.0) < 1e-5 and abs(row[1]) < 1e-5


def test_range_check_quarantines_nan_and_null(spark):
    df = spark.createDataFrame([(0.0,), (100.0,), (-0.01,), (100.01,), (float("nan"),), (None,)], "p double")
    got = [(r.valid, r.reason) for r in quality.range_check(df, "p").collect()]
    assert got == [(True, None), (True, None), (False, "below"), (False, "above"),
                   (False, "nan"), (False, "null")]


def test_label_domain_truncates(spark):
    df = spark.createDataFrame([(0.9,), (1.7,), (2.0,), (-0.5,)], "p double")
    got = [(r.label_int, r.valid) for r in quality.valid_labels(df, "p").collect()]
    assert got == [(0, True), (1, True), (2, False), (0, True)]


def test_correlation_with_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, 2.0), (3.0, 5.0, 2.5)], "a double, c double, y double")
    got = {r.feature: r.correlation for r in metrics.target_correlation(df, ["a", "c"], "y").collect()}
    assert got["c"] is None
    assert 0.9 < got["a"] <= 1.0


def test_scaler_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, c double")
    got = {r.feature: (r.mean, r.std) for r in metrics.scaler_stats(df, ["a", "c"]).collect()}
    assert got["a"] == (2.0, 1.0)
    assert got["c"] == (7.0, 1.0)


def test_perfect_prediction_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (4.0, 4.0)], "y double, p double")
    r = metrics.regression_metrics(df, "y", "p").first()
    assert r.r2 == 1.0 and r.rmse == 0.0


def test_classification_report_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, p int")
    rows = {r.label: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert rows["1"].precision == 0.0 and rows["1"].recall == 0.0 and rows["1"].f1 == 0.0
    assert rows["accuracy"].f1 == pytest.approx(2 / 3)
    assert rows["0"].support == 2 and rows["weighted avg"].support == 3


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    got = {r.y: r.weight for r in metrics.class_weights(df, "y").collect()}
    assert got == {0: 4 / 6, 1: 2.0}


def test_nan_to_null_and_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    got = [(r.y, r.m) for r in df.select(scalar.nan_to_null("x").alias("y"), scalar.is_missing("x").alias("m")).collect()]
    assert got == [(1.0, False), (None, True), (None, True)]

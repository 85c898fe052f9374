import pytest

from loamline.operators import quality
from loamline.schemas import MOISTURE_FEATURES, MOISTURE_TARGET, NUTRIENTS


def _frame(spark, cols, rows=None):
    schema = ", ".join(f"`{c}` double" for c in cols)
    return spark.createDataFrame(rows or [tuple(float(i) for i in range(len(cols)))], schema)


def test_contract_accepts_features_and_target(spark):
    quality.check_frame(_frame(spark, MOISTURE_FEATURES + [MOISTURE_TARGET]), MOISTURE_FEATURES, MOISTURE_TARGET)


def test_contract_ignores_id(spark):
    quality.check_frame(_frame(spark, ["id"] + MOISTURE_FEATURES + [MOISTURE_TARGET]),
                        MOISTURE_FEATURES, MOISTURE_TARGET)


def test_contract_missing_target(spark):
    with pytest.raises(quality.FrameContractError, match="target"):
        quality.check_frame(_frame(spark, MOISTURE_FEATURES), MOISTURE_FEATURES, MOISTURE_TARGET)


def test_contract_missing_and_extra(spark):
    with pytest.raises(quality.FrameContractError, match="missing"):
        quality.check_frame(_frame(spark, MOISTURE_FEATURES[1:] + [MOISTURE_TARGET]),
                            MOISTURE_FEATURES, MOISTURE_TARGET)
    with pytest.raises(quality.FrameContractError, match="unexpected"):
        quality.check_frame(_frame(spark, MOISTURE_FEATURES + ["extra", MOISTURE_TARGET]),
                            MOISTURE_FEATURES, MOISTURE_TARGET)


def test_contract_missing_nutrients(spark):
    cols = [c for c in NUTRIENTS if c not in ("N", "Fe")]
    with pytest.raises(quality.FrameContractError, match="N"):
        quality.check_frame(_frame(spark, cols), NUTRIENTS)


def test_values_reject_nulls_inf_and_empty(spark):
    cols = ["a", "b"]
    with pytest.raises(quality.FrameContractError, match="missing values"):
        quality.check_values(_frame(spark, cols, [(1.0, None)]), cols)
    with pytest.raises(quality.FrameContractError, match="infinite"):
        quality.check_values(_frame(spark, cols, [(1.0, float("inf"))]), cols)
    with pytest.raises(quality.FrameContractError, match="empty"):
        quality.check_values(_frame(spark, cols).limit(0), cols)


def test_split_complete_reasons(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.0), (3, float("nan"), None)],
                               "id long, a double, b double")
    acc, rej = quality.split_complete(df, ["a", "b"])
    assert [r.id for r in acc.collect()] == [1]
    assert {r.id: r.reason for r in rej.collect()} == {2: "incomplete: a", 3: "incomplete: a,b"}


def test_null_nutrient_rejected(spark):
    cols = NUTRIENTS
    row = tuple([None] + [float(i) for i in range(2, 13)])
    df = spark.createDataFrame([tuple(float(i) for i in range(1, 13)), row], ", ".join(f"`{c}` double" for c in cols))
    acc, rej = quality.split_complete(df, cols)
    assert acc.count() == 1 and rej.count() == 1


def test_binary_labels_drop_two(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "Output int")
    assert sorted(r.Output for r in quality.binary_labels(df).collect()) == [0, 1]

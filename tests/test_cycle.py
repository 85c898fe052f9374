"""Cycle-level behaviours of the reference's prediction loop, on the batch
form of the streaming cycle (``windowed.cycle_batch``)."""

import datetime as dt

import pandas as pd
import pytest

from loamline.operators.models import LinearModel, Scaler
from loamline.schemas import MOISTURE_FEATURES, READINGS
from loamline.streaming import windowed

BASE = dt.datetime(2024, 1, 1)
# Seeded history and the three live cycles of the reference's
# integration tests (hour, temperature, rain, moisture %).
SEED = [25.0, 26.0, 27.0, 28.0, 29.0]
THREE_CYCLES = [(8, 21.0, 0.0, 34.5), (9, 21.8, 0.1, 34.2), (10, 22.5, 0.0, 33.9)]


def _readings(spark, cycles):
    rows = [(1, i, BASE + dt.timedelta(hours=i), i, 20.0, 0.1, v / 100) for i, v in enumerate(SEED)]
    for j, (h, t, r, v) in enumerate(cycles):
        i = len(SEED) + j
        rows.append((1, i, BASE + dt.timedelta(hours=i), h, t, r, v / 100))
    return spark.createDataFrame(pd.DataFrame(rows, columns=[f.name for f in READINGS]), READINGS)


def _constant_model(value):
    return LinearModel(Scaler(MOISTURE_FEATURES, [0.0] * 9, [1.0] * 9), [0.0] * 9, float(value))


def _run(spark, cycles, prediction):
    tail = spark.createDataFrame([], windowed.TAIL_SCHEMA)
    out, nxt = windowed.cycle_batch(_readings(spark, cycles), tail, _constant_model(prediction),
                                    whole=True)
    rows = sorted(out.collect(), key=lambda r: r.event_id)  # one action for all stores
    return {s: [r for r in rows if r.store == s]
            for s in ("permanent", "training", "prediction", "rejected")}, nxt


def test_three_cycles_store_three_rows(spark):
    out, nxt = _run(spark, THREE_CYCLES, 36.0)
    # two rows already labelled, the third still pending (kept in the tail)
    assert [r.label for r in out["training"]] == pytest.approx([34.2, 33.9])
    assert [r.soil_temp for r in out["training"]] == pytest.approx([21.0, 21.8])
    pending = nxt.filter("pend_train").collect()
    assert len(pending) == 1 and pending[0].ctx_soil_temp == pytest.approx(22.5)
    assert out["rejected"] == []


def test_in_range_prediction_is_logged_with_next_actual(spark):
    out, _ = _run(spark, THREE_CYCLES, 36.0)
    preds = out["prediction"]
    assert [r.predicted for r in preds] == [36.0, 36.0]
    assert [r.label for r in preds] == pytest.approx([34.2, 33.9])
    assert [r.absolute_error for r in preds] == pytest.approx([1.8, 2.1])


def test_out_of_range_prediction_is_stored_but_not_logged(spark):
    out, nxt = _run(spark, THREE_CYCLES, -999.0)
    assert out["prediction"] == []
    assert nxt.filter("pend_pred").count() == 0
    assert [r.reason for r in out["rejected"]] == ["prediction out of range"] * 3
    assert len(out["training"]) == 2  # features were stored before the check


def test_boundary_predictions(spark):
    assert len(_run(spark, THREE_CYCLES, 100.0)[0]["prediction"]) == 2
    assert len(_run(spark, THREE_CYCLES, 55.0)[0]["prediction"]) == 2
    assert len(_run(spark, THREE_CYCLES, 100.01)[0]["prediction"]) == 0

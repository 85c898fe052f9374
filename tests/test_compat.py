"""The live loop replayed as windows equals the loop itself.

``LoopModel`` is a direct, cycle-by-cycle model of the reference's stores:
read the last five completed rows, back-fill the permanent store's pending
row, build features, skip incomplete cycles, back-fill and insert into both
stores. The windowed ``compat_cycles`` must give the same rows.
"""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from loamline.operators import backfill, features

BASE = dt.datetime(2024, 1, 1)


def f32(x):
    return float(np.float32(x))


class LoopModel:
    def __init__(self, seed_futures):
        # permanent rows: [id, feats, future]; the seed is fully completed
        self.perm = [[i, None, f] for i, f in enumerate(seed_futures)]
        self.temp = []
        self.next_id = len(seed_futures)

    @staticmethod
    def _backfill(rows, value):
        for row in reversed(rows):
            if row[2] is None:
                row[2] = value
                return

    def cycle(self, hour, temp, rain, reading, key):
        history = [r for r in self.perm if r[2] is not None][-5:]
        self._backfill(self.perm, reading)
        prevs = [r[2] for r in history]
        prevs = [None] * (5 - len(prevs)) + prevs
        vals = [math.sin(2 * math.pi * hour / 24), math.cos(2 * math.pi * hour / 24),
                None if temp is None else float(np.rint(temp * 100) / 100),
                None if rain is None else float(np.rint(rain * 100) / 100)] + prevs
        if any(v is None for v in vals):
            return
        feats = [f32(v) for v in vals]
        self._backfill(self.perm, reading)
        self.perm.append([key, feats, None])
        self._backfill(self.temp, reading)
        self.temp.append([key, feats, None])


def _readings(spark, seed, cycles):
    rows = []
    t = 0
    for v in seed:
        rows.append((1, 0, BASE + dt.timedelta(hours=t), t, 20.0, 0.0, v / 100))
        t += 1
    for hour, temp, rain, v in cycles:
        rows.append((1, t, BASE + dt.timedelta(hours=t), hour, temp, rain, v / 100))
        t += 1
    pdf = pd.DataFrame(rows, columns=["station_id", "event_id", "ts", "hour", "soil_temp", "rain_fall", "soil_moisture"])
    pdf["event_id"] = range(len(pdf))
    return spark.createDataFrame(pdf, "station_id long, event_id long, ts timestamp_ntz, hour int, "
                                      "soil_temp double, rain_fall double, soil_moisture double")


def test_golden_trace(spark):
    """Five live cycles after the seeded history (values from the
    reference's temporary-store trace)."""
    seed = [5.2, 5.2, 34.5, 33.9, 33.3]
    live = [(8, 21.0, 0.0, 34.5), (9, 21.8, 0.1, 34.2), (10, 22.5, 0.0, 33.9),
            (11, 23.1, 0.0, 33.6), (12, 23.8, 0.0, 33.3)]
    cyc = features.compat_cycles(_readings(spark, seed, live))
    queue = backfill.training_rows(cyc).orderBy("ts").collect()
    assert [round(r.soil_temp, 4) for r in queue] == [21.0, 21.8, 22.5, 23.1, 23.8]
    assert [round(r.prev_1, 4) for r in queue] == [33.3, 33.3, 34.2, 33.9, 33.6]
    fut = [None if r.future_moisture is None else round(r.future_moisture, 4) for r in queue]
    assert fut == [34.2, 33.9, 33.6, 33.3, None]
    # exactly one pending row after n cycles
    assert sum(r.future_moisture is None for r in queue) == 1


def test_insufficient_history_rejected(spark):
    """Fewer readings than the seed: nothing is stored."""
    cyc = features.compat_cycles(_readings(spark, [30.0, 31.0, 32.0], []))
    assert cyc.filter("accepted").count() == 0


cycle_strategy = st.lists(st.tuples(st.integers(0, 23), st.one_of(st.none(), st.floats(0, 40)),
                                    st.floats(0, 5), st.floats(1, 99)), min_size=1, max_size=25)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(1, 99), min_size=5, max_size=5), cycle_strategy)
def test_windows_equal_loop(spark, seed, cycles):
    model = LoopModel(seed)
    for i, (hour, temp, rain, v) in enumerate(cycles):
        model.cycle(hour, temp, rain, (v / 100) * 100, 5 + i)
    cyc = features.compat_cycles(_readings(spark, seed, cycles))
    perm = {r.event_id: r for r in features.feature_rows_compat(_readings(spark, seed, cycles)).collect()}
    temp = {r.event_id: r for r in backfill.training_rows(cyc).collect()}
    want_perm = {k: (f, fut) for k, f, fut in model.perm if f is not None}
    want_temp = {k: (f, fut) for k, f, fut in model.temp}
    assert set(perm) == set(want_perm)
    assert set(temp) == set(want_temp)
    cols = ["hour_sin", "hour_cos", "soil_temp", "rain_fall", "prev_5", "prev_4", "prev_3", "prev_2", "prev_1"]
    for store, want in ((perm, want_perm), (temp, want_temp)):
        for k, (f, fut) in want.items():
            row = store[k]
            assert [row[c] for c in cols] == pytest.approx(f, abs=1e-6)
            assert (row.future_moisture is None) == (fut is None)
            if fut is not None:
                assert row.future_moisture == pytest.approx(fut)


def test_null_reading_is_rejected_on_ingest(spark):
    """A missing reading is not a cycle: the rows around it are labelled as
    if it never arrived."""
    seed = [30.0, 31.0, 32.0, 33.0, 34.0]
    live = [(8, 21.0, 0.0, 35.0), (9, 21.0, 0.0, float("nan")), (10, 21.0, 0.0, 36.0), (11, 21.0, 0.0, 37.0)]
    with_gap = _readings(spark, seed, live)
    without = _readings(spark, seed, [live[0], live[2], live[3]])
    q1 = backfill.training_rows(features.compat_cycles(with_gap))
    q2 = backfill.training_rows(features.compat_cycles(without))
    cols = ["soil_temp", "prev_1", "prev_2", "future_moisture"]
    a = [tuple(r[c] for c in cols) for r in q1.orderBy("ts").collect()]
    b = [tuple(r[c] for c in cols) for r in q2.orderBy("ts").collect()]
    assert a == b and len(a) == 3

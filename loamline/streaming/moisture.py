"""The moisture prediction cycle as a stateful Structured Streaming query.

Per station the state holds at most: the last five chain values, whether the
previous cycle was accepted, and three pending rows (the last accepted cycle
waiting for the next reading, the last accepted cycle waiting for the next
accepted reading, the last logged prediction waiting for the next logged
reading). Every reading closes what it completes and emits it, in append
mode:

* ``permanent``  -- feature row labelled with the next cycle's reading
* ``training``   -- feature row labelled with the next accepted reading
* ``prediction`` -- logged prediction with the next logged reading and error
* ``rejected``   -- incomplete cycle, out-of-range prediction or late row

The result equals the batch derivations (``features.compat_cycles``,
``backfill``): see ``tests/test_streaming.py``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loamline.operators.models import LinearModel
from loamline.schemas import HISTORY, MOISTURE_FEATURES, MOISTURE_RANGE

OUTPUT_SCHEMA = ("store string, station_id long, event_id long, ts_us long, "
                 + ", ".join(f"{c} double" for c in MOISTURE_FEATURES)
                 + ", label double, predicted double, absolute_error double, reason string")

STATE_SCHEMA = ("n_seen long, chain array<double>, prev_ok boolean, last_ts long, last_id long, "
                "perm_id long, perm_ts long, perm_feats array<double>, "
                "train_id long, train_ts long, train_feats array<double>, "
                "pred_id long, pred_ts long, pred_value double")

_TWO_PI = 2 * math.pi
# Wall-clock epoch: microsecond offsets from it do not depend on the session
# time zone (no DST gaps or overlaps).
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _f32(x: float | None) -> float | None:
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    return float(np.float32(x))


def _round2(x: float | None) -> float | None:
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    return float(np.rint(x * 100.0) / 100.0)


def _missing(x) -> bool:
    return x is None or (isinstance(x, float) and math.isnan(x))


COLUMNS = [c.split()[0] for c in OUTPUT_SCHEMA.split(", ")]


def scorer(model: LinearModel):
    """The model on a dict of features. Nine weights and the frozen scaler, by value."""
    terms = [(f, w, m, s) for f, w, m, s in zip(model.scaler.features, model.weights, model.scaler.mean, model.scaler.std)]
    intercept = float(model.intercept)

    def score(feats: dict) -> float:
        p = intercept
        for f, w, m, s in terms:
            p = p + w * ((feats[f] - m) / s)
        return p

    return score


class Cycle:
    """One station's state and its transition on a reading. ``pending`` holds, by
    kind, the rows waiting for a later reading: (event_id, ts, features, prediction)."""

    def __init__(self, station: int, score, seed: int = HISTORY,
                 lo: float = MOISTURE_RANGE[0], hi: float = MOISTURE_RANGE[1]):
        self.station, self.score, self.seed, self.lo, self.hi = station, score, seed, lo, hi
        self.n_seen, self.chain, self.prev_ok, self.last_ts, self.last_id = 0, [], False, None, None
        self.pending: dict[str, tuple] = {}
        self.out: list[dict] = []

    def emit(self, store, eid, ts, feats, label=None, predicted=None, err=None, reason=None):
        row = {"store": store, "station_id": self.station, "event_id": eid, "ts_us": ts,
               "label": label, "predicted": predicted, "absolute_error": err, "reason": reason}
        for i, c in enumerate(MOISTURE_FEATURES):
            row[c] = None if feats is None else feats[i]
        self.out.append(row)

    def step(self, r) -> None:
        eid, ts = int(r.event_id), int(r.ts_us)
        if self.last_ts is not None and (ts, eid) <= (self.last_ts, self.last_id):
            self.emit("rejected", eid, ts, None, reason="late")
            return
        if _missing(r.soil_moisture):
            self.emit("rejected", eid, ts, None, reason="null reading")
            return
        self.last_ts, self.last_id = ts, eid
        reading = float(r.soil_moisture)
        # the previous cycle, if accepted, gets this reading as its label
        if "permanent" in self.pending:
            self.emit("permanent", *self.pending.pop("permanent")[:3], label=reading)
        is_seed = self.n_seen < self.seed
        self.n_seen += 1
        hour = None if _missing(r.hour) else float(r.hour)
        feats = {
            "hour_sin": _f32(None if hour is None else math.sin(_TWO_PI * hour / 24)),
            "hour_cos": _f32(None if hour is None else math.cos(_TWO_PI * hour / 24)),
            "soil_temp": _f32(_round2(None if _missing(r.soil_temp) else float(r.soil_temp))),
            "rain_fall": _f32(_round2(None if _missing(r.rain_fall) else float(r.rain_fall))),
        }
        back = self.chain[::-1] + [None] * HISTORY
        for k in range(1, HISTORY + 1):
            feats[f"prev_{k}"] = _f32(back[k - 1])
        vec = [feats[c] for c in MOISTURE_FEATURES]
        accepted = (not is_seed) and not any(v is None for v in vec)
        # chain: seed readings, and readings that found a pending row
        if is_seed or self.prev_ok:
            self.chain = (self.chain + [reading])[-HISTORY:]
        self.prev_ok = accepted
        if is_seed:
            return
        if not accepted:
            missing = [c for c, v in zip(MOISTURE_FEATURES, vec) if v is None]
            self.emit("rejected", eid, ts, vec, reason="incomplete: " + ",".join(missing))
            return
        self.pending["permanent"] = (eid, ts, vec, None)
        if "training" in self.pending:
            self.emit("training", *self.pending["training"][:3], label=reading)
        self.pending["training"] = (eid, ts, vec, None)
        p = self.score(feats)
        if not (self.lo <= p <= self.hi):
            self.emit("rejected", eid, ts, vec, predicted=p, reason="prediction out of range")
            return
        if "prediction" in self.pending:
            old_id, old_ts, _, old = self.pending["prediction"]
            self.emit("prediction", old_id, old_ts, None, label=reading, predicted=old, err=abs(old - reading))
        self.pending["prediction"] = (eid, ts, None, p)

    def emitted(self) -> pd.DataFrame:
        """The rows emitted since the last call; object columns, so Arrow types come from the schema."""
        rows, self.out = self.out, []
        return pd.DataFrame([[r[c] for c in COLUMNS] for r in rows], columns=COLUMNS, dtype=object)


def make_cycle_fn(model: LinearModel, seed: int = HISTORY,
                  lo: float = MOISTURE_RANGE[0], hi: float = MOISTURE_RANGE[1]):
    """Build the per-station state function. ``model`` is captured by value."""
    score = scorer(model)

    def fn(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        cycle = Cycle(int(key[0]), score, seed, lo, hi)
        if state.exists:
            n_seen, chain, prev_ok, last_ts, last_id, *rows = state.get
            cycle.n_seen, cycle.chain, cycle.prev_ok = n_seen, list(chain or []), prev_ok
            cycle.last_ts, cycle.last_id = last_ts, last_id
            for k, kind in enumerate(("permanent", "training")):
                if rows[3 * k] is not None:
                    cycle.pending[kind] = (*rows[3 * k:3 * k + 3], None)
            if rows[6] is not None:
                cycle.pending["prediction"] = (rows[6], rows[7], None, rows[8])
        pdf = pd.concat(list(batches), ignore_index=True)
        for r in pdf.sort_values(["ts_us", "event_id"], kind="mergesort").itertuples(index=False):
            cycle.step(r)
        perm = cycle.pending.get("permanent", (None,) * 4)
        train, pred = cycle.pending.get("training", (None,) * 4), cycle.pending.get("prediction", (None,) * 4)
        state.update((cycle.n_seen, cycle.chain, cycle.prev_ok, cycle.last_ts, cycle.last_id,
                      *perm[:3], *train[:3], pred[0], pred[1], pred[3]))
        yield cycle.emitted()

    return fn


def prepared(readings: DataFrame, keys: Sequence[str] = ("station_id",)) -> DataFrame:
    """The columns a cycle reads: times in microseconds, moisture in percent."""
    return readings.select(
        *keys, "event_id", F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, ts)").alias("ts_us"),
        "hour", "soil_temp", "rain_fall", (F.col("soil_moisture") * F.lit(100)).alias("soil_moisture"))


def moisture_cycles(readings: DataFrame, model: LinearModel, *, seed: int = HISTORY,
                    keys: Sequence[str] = ("station_id",)) -> DataFrame:
    """Stateful cycle over a streaming readings DataFrame with
    ``station_id, event_id, ts, hour, soil_temp, rain_fall, soil_moisture``
    (moisture as a fraction, as the adapters produce it). Spark runs
    ``applyInPandasWithState`` only in streaming queries; the batch form of
    the same cycle is ``streaming.windowed.cycle_batch``."""
    return prepared(readings, keys).groupBy(*keys).applyInPandasWithState(
        make_cycle_fn(model, seed), OUTPUT_SCHEMA, STATE_SCHEMA, "append",
        GroupStateTimeout.NoTimeout)


def idempotent_sink(path: str):
    """``foreachBatch`` writer: each micro-batch goes to its own folder,
    overwritten on a retry, so a replayed batch never duplicates rows."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("ts", F.expr(f"timestampadd(MICROSECOND, ts_us, {_EPOCH})"))
         .withColumn("logged_at", F.current_timestamp())
         .write.mode("overwrite").partitionBy("store").parquet(f"{path}/batch_id={batch_id}"))
    return write

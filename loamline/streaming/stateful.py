"""The moisture prediction cycle in event time, as a stateful processor.

Readings may arrive in any order within the watermark's delay. A station's
readings wait in its map state, one entry per slot of ``SLOT_SECONDS``; a timer
at the slot's end fires when the watermark has passed it, and then that slot
alone is read, put in order and stepped through (``moisture.Cycle``). So neither
a station's micro-batch nor its backlog is ever held at once: a task holds one
batch of Arrow rows or one slot. The cycle's own state is a value (counter,
five chain values, newest reading) and a list (at most three rows that wait
for a later reading).

A reading older than the watermark's closed slots is emitted as rejected,
"late", exactly those the batch replay would have seen earlier. A station
without a reading for ``idle_seconds`` of event time expires: an idle timer
emits its waiting rows as rejected, "idle", and clears its state; if it
comes back, it warms up anew. Readings without a time are rejected.

Output rows and stores are those of ``moisture.moisture_cycles``; the query
survives a restart at any batch, since all it knows is in the state store.
The session needs the RocksDB state store (``STATE_STORE``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from loamline.operators.models import LinearModel
from loamline.schemas import HISTORY, MOISTURE_RANGE
from loamline.streaming.moisture import OUTPUT_SCHEMA, Cycle, prepared, scorer

STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
SLOT_SECONDS = 3600
IDLE_SECONDS = 30 * 86_400
DELAY = "2 hours"

_VALUE = "n_seen long, chain array<double>, prev_ok boolean, last_ts long, last_id long, idle_at long"
_WAITING = "kind string, event_id long, ts_us long, feats array<double>, predicted double"
_READING = "event_id: long, ts_us: long, hour: double, soil_temp: double, rain_fall: double, soil_moisture: double"
_FIELDS = [f.split(":")[0].strip() for f in _READING.split(",")]


class _Row:
    __slots__ = _FIELDS

    def __init__(self, values):
        for name, value in zip(_FIELDS, values):
            setattr(self, name, value)


class MoistureProcessor(StatefulProcessor):
    def __init__(self, model: LinearModel, seed: int, slot_seconds: int, idle_seconds: int):
        self.model, self.seed, self.slot_ms, self.idle_ms = model, seed, slot_seconds * 1000, idle_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.score = handle, scorer(self.model)
        self.value = handle.getValueState("cycle", _VALUE)
        self.waiting = handle.getListState("waiting", _WAITING)
        self.slots = handle.getMapState("slots", "slot long", f"readings array<struct<{_READING}>>")

    def _cycle(self, key) -> tuple[Cycle, int | None]:
        cycle, idle_at = Cycle(int(key[0]), self.score, self.seed, *MOISTURE_RANGE), None
        if self.value.exists():
            n_seen, chain, prev_ok, last_ts, last_id, idle_at = self.value.get()
            cycle.n_seen, cycle.chain, cycle.prev_ok = n_seen, list(chain or []), prev_ok
            cycle.last_ts, cycle.last_id = last_ts, last_id
            for kind, eid, ts, feats, predicted in self.waiting.get():
                cycle.pending[kind] = (eid, ts, None if feats is None else list(feats), predicted)
        return cycle, idle_at

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs() // self.slot_ms  # slots before this one have been read
        refused = Cycle(int(key[0]), self.score)
        for pdf in rows:
            timed = pdf["ts_us"].notna()
            for r in pdf[~timed].itertuples(index=False):
                refused.emit("rejected", int(r.event_id), None, None, reason="no time")
            pdf = pdf[timed]
            slots = pdf["ts_us"].astype("int64") // (self.slot_ms * 1000)
            for slot, part in pdf.groupby(slots):
                slot = int(slot)
                if slot < closed:
                    for r in part.itertuples(index=False):
                        refused.emit("rejected", int(r.event_id), int(r.ts_us), None, reason="late")
                    continue
                whole = lambda x: None if pd.isna(x) else float(x)
                new = [(int(r.event_id), int(r.ts_us), whole(r.hour), whole(r.soil_temp), whole(r.rain_fall),
                        whole(r.soil_moisture)) for r in part.itertuples(index=False)]
                if self.slots.containsKey((slot,)):
                    new = [tuple(r) for r in self.slots.getValue((slot,))[0]] + new
                else:
                    self.handle.registerTimer((slot + 1) * self.slot_ms)
                self.slots.updateValue((slot,), (new,))
        yield refused.emitted()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        due = sorted(slot for (slot,) in self.slots.keys() if (slot + 1) * self.slot_ms <= passed)
        cycle, idle_at = self._cycle(key)
        for slot in due:  # an earlier slot's timer may have read them already
            rows = (_Row(r) for r in self.slots.getValue((slot,))[0])
            for r in sorted(rows, key=lambda r: (r.ts_us, r.event_id)):
                if cycle.last_ts is not None and r.ts_us // 1000 >= cycle.last_ts // 1000 + self.idle_ms:
                    cycle = self._expired(cycle)
                cycle.step(r)
            self.slots.removeKey((slot,))
            yield cycle.emitted()
        if due and cycle.last_ts is not None:
            if idle_at is not None:
                self.handle.deleteTimer(idle_at)
            idle_at = cycle.last_ts // 1000 + self.idle_ms
            self.handle.registerTimer(idle_at)
            self._save(cycle, idle_at)
        elif idle_at is not None and idle_at <= passed and not due:
            cycle = self._expired(cycle)
            self.value.clear()
            self.waiting.clear()
            yield cycle.emitted()

    def _expired(self, cycle: Cycle) -> Cycle:
        """A new cycle of a station that was idle; what waited for a reading is rejected."""
        fresh = Cycle(cycle.station, self.score, self.seed, *MOISTURE_RANGE)
        fresh.out = cycle.out
        for kind in sorted(cycle.pending):
            eid, ts, feats, predicted = cycle.pending[kind]
            fresh.emit("rejected", eid, ts, feats, predicted=predicted, reason=f"idle: {kind}")
        return fresh

    def _save(self, cycle: Cycle, idle_at: int) -> None:
        self.value.update((cycle.n_seen, cycle.chain, cycle.prev_ok, cycle.last_ts, cycle.last_id, idle_at))
        if cycle.pending:
            self.waiting.put([(kind, *row) for kind, row in cycle.pending.items()])
        else:
            self.waiting.clear()

    def close(self) -> None:
        pass


def event_time_cycles(readings: DataFrame, model: LinearModel, *, seed: int = HISTORY, delay: str = DELAY,
                      slot_seconds: int = SLOT_SECONDS, idle_seconds: int = IDLE_SECONDS) -> DataFrame:
    """The cycle over a streaming readings DataFrame (``station_id, event_id, ts,
    hour, soil_temp, rain_fall, soil_moisture``; moisture as a fraction). Wall-clock
    times are read as UTC, which is the session's time zone."""
    timed = prepared(readings).withColumn("at", F.timestamp_micros("ts_us")).withWatermark("at", delay)
    # without the watermark's column Spark drops no late row: the processor accounts for each
    return timed.drop("at").groupBy("station_id").transformWithStateInPandas(
        MoistureProcessor(model, seed, slot_seconds, idle_seconds), OUTPUT_SCHEMA, "Append", "EventTime")

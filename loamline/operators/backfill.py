"""Row mutations of the reference (UPDATE/DELETE) as columns derived from
immutable logs.

* permanent label  = next cycle's reading           (``lead`` over all cycles)
* training label   = next accepted cycle's reading   (``lead`` over accepted)
* prediction actual = next logged cycle's reading    (``lead`` over logged)
* flush            = rows whose label was known at the run are consumed; the
                     queue is the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from loamline.functions.scalar import absolute_error
from loamline.operators.quality import in_range
from loamline.operators.series import PART, latest, per_size, shift
from loamline.operators.features import compat_cycles
from loamline.schemas import KEYS, MOISTURE_FEATURES, MOISTURE_TARGET, ORDER


def completed(rows: DataFrame, target: str = MOISTURE_TARGET) -> DataFrame:
    return rows.filter(F.col(target).isNotNull())


def pending(rows: DataFrame, target: str = MOISTURE_TARGET) -> DataFrame:
    return rows.filter(F.col(target).isNull())


def latest_pending(rows: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER,
                   target: str = MOISTURE_TARGET) -> DataFrame:
    """Newest row still waiting for its label, per key (partial aggregation)."""
    cols = [c for c in rows.columns if c not in keys]
    return latest(pending(rows, target), keys, order, cols)


def backfill_future(cycles: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER,
                    **how) -> DataFrame:
    """Accepted cycles with both labels: ``future_permanent`` (next cycle) and
    ``future_training`` (next accepted cycle)."""
    keys, order = list(keys), list(order)
    acc = cycles.filter("accepted")
    return shift(acc, keys, order, leads={"future_training": ("soil_moisture", 1),
                                          "next_accepted": (order[0], 1)}, **how)


def training_rows(cycles: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER,
                  **kw) -> DataFrame:
    """The training queue: accepted cycles labelled with the next accepted
    reading (NULL = pending)."""
    keys, order = list(keys), list(order)
    return (backfill_future(cycles, keys, order, **kw)
            .select(*keys, *order, *MOISTURE_FEATURES,
                    F.col("future_training").alias(MOISTURE_TARGET)))


def prediction_log(cycles: DataFrame, predicted: str, keys: Sequence[str] = KEYS,
                   order: Sequence[str] = ORDER, *, lo: float = 0.0, hi: float = 100.0,
                   **how) -> DataFrame:
    """Logged predictions: accepted cycles whose prediction passed the range
    check, with the actual value of the next logged cycle and its error."""
    keys, order = list(keys), list(order)
    logged = cycles.filter(F.col("accepted") & in_range(predicted, lo, hi))
    part = [PART] if PART in cycles.columns else []
    out = shift(logged.select(*keys, *order, *part, F.col(predicted).alias("predicted_moisture"),
                              "soil_moisture"),
                keys, order, leads={"actual_moisture": ("soil_moisture", 1)}, **how)
    return (out.withColumn("absolute_error", absolute_error("predicted_moisture", "actual_moisture"))
            .drop("soil_moisture", *part))


def replayed(readings: DataFrame, each, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER) -> DataFrame:
    """``each(cycles, **how)`` over the live loop's cycles, where ``how`` tells the
    label operators above how these keys are treated. Keys are sized once, so
    the replay and its labels share one plan per size."""
    keys, order = list(keys), list(order)

    def one(rows, part):
        how = {"whole": True} if part is None else {"bucket": F.col(PART)}
        out = each(compat_cycles(rows, keys, order, **how), **how)
        return out.drop(PART)

    return per_size(readings, keys, order, one)


def flush_remaining(cycles: DataFrame, cutoff, keys: Sequence[str] = KEYS,
                    order: Sequence[str] = ORDER, **how) -> DataFrame:
    """The training queue after a retraining run at ``cutoff`` consumed the rows
    it could see completed. The replay is causal and the next accepted reading
    moves forward along a series, so a row was consumed exactly if its own
    label was known then: one pass, no join."""
    keys, order = list(keys), list(order)
    rows = backfill_future(cycles, keys, order, **how)
    return (rows.filter(~F.coalesce(F.col("next_accepted") < cutoff, F.lit(False)))
            .select(*keys, *order, *MOISTURE_FEATURES, F.col("future_training").alias(MOISTURE_TARGET)))

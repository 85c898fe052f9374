"""Moisture feature rows: cyclic hour, five earlier readings, next reading.

Two modes of one definition:

* ``moisture_features`` -- the batch training table: plain lags and a lead
  over every reading of a station (the reference's feature SQL).
* ``compat_cycles`` -- the live loop replayed as windows. A reading enters
  the lag chain only if the previous cycle stored a pending row, features are
  rounded and narrowed to float32, and the first ``seed`` readings of a
  station play the role of the seeded history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loamline.functions.scalar import float32, hour_cos, hour_sin, is_missing, round_half_even
from loamline.operators.series import PART, per_size, shift
from loamline.schemas import HISTORY, KEYS, MOISTURE_FEATURES, MOISTURE_TARGET, ORDER

def normalise(readings: DataFrame) -> DataFrame:
    """Reading in percent (the source holds a fraction) plus the hour encoding."""
    return readings.withColumns({"hour_sin": hour_sin("hour"), "hour_cos": hour_cos("hour"),
                                 "soil_moisture": F.col("soil_moisture") * F.lit(100)})


def normalise_columns(raw: DataFrame) -> DataFrame:
    """Re-case the raw CSV columns (``Hour_sin``, ``Soil_Temp``, ...) and scale
    the moisture fraction to percent."""
    return raw.select(
        *[c for c in raw.columns if c not in
          ("Hour_sin", "Hour_cos", "Soil_Temp", "Rainfall", "Soil_Moisture")],
        F.col("Hour_sin").alias("hour_sin"),
        F.col("Hour_cos").alias("hour_cos"),
        F.col("Soil_Temp").alias("soil_temp"),
        F.col("Rainfall").alias("rain_fall"),
        (F.col("Soil_Moisture") * F.lit(100)).alias("soil_moisture"))


def moisture_features(readings: DataFrame, keys: Sequence[str] = KEYS,
                      order: Sequence[str] = ORDER, *,
                      bucket_seconds: float | None = None,
                      normalised: bool = False, bucket: Column | None = None,
                      whole: bool = False) -> DataFrame:
    """Training rows: hour encoding, temperature, rain, five earlier readings
    and the next reading; rows without a fifth lag or a next reading dropped.
    Keys are treated by their size unless ``whole`` or ``bucket`` says how; the
    bucket is kept in ``PART`` then."""
    keys, order = list(keys), list(order)
    kept = [] if bucket is None else [PART]
    r = readings if normalised else normalise(readings)
    r = r.select(*keys, *order, "hour_sin", "hour_cos", "soil_temp", "rain_fall", "soil_moisture",
                 *([] if bucket is None else [bucket.alias(PART)]))
    lags = {f"prev_{k}": ("soil_moisture", k) for k in range(1, HISTORY + 1)}
    out = shift(r, keys, order, lags=lags, leads={MOISTURE_TARGET: ("soil_moisture", 1)},
                bucket_seconds=bucket_seconds, bucket=None if bucket is None else F.col(PART), whole=whole)
    return (out.filter(F.col("prev_5").isNotNull() & F.col(MOISTURE_TARGET).isNotNull())
            .select(*keys, *order, *MOISTURE_FEATURES, MOISTURE_TARGET, *kept))


def compat_cycles(readings: DataFrame, keys: Sequence[str] = KEYS,
                  order: Sequence[str] = ORDER, *, seed: int = HISTORY,
                  context: str | None = None, carry: Sequence[str] = (),
                  bucket: Column | None = None, whole: bool = False) -> DataFrame:
    """Every reading as one cycle of the live loop (readings that are NULL or
    NaN are not cycles: they are rejected on ingest).

    Columns added: ``is_seed`` (one of the first ``seed`` readings),
    ``accepted`` (a live cycle whose nine features are all present),
    ``chain`` (the reading if it became a lag: seed, or the previous live
    cycle was accepted), ``prev_5..prev_1`` (the last five chain values
    before the cycle), the float32 features, and ``future_permanent`` (next
    cycle's reading, the permanent store's label).

    ``context``: name of a boolean column marking rows carried over from an
    earlier run (a streaming tail). Their ``is_seed``, ``chain``,
    ``accepted`` and features are taken from ``ctx_<name>`` columns instead
    of being recomputed; new rows see them as history. ``carry`` lists
    further input columns to keep. Keys are treated by their size
    (``series.per_size``) unless ``whole`` or ``bucket`` says how.
    """
    keys, order = list(keys), list(order)
    if bucket is None and not whole:
        return per_size(readings, keys, order, lambda rows, part: compat_cycles(
            rows, keys, order, seed=seed, context=context, carry=carry, bucket=part,
            whole=part is None).drop(PART))
    extra = list(carry)
    if bucket is not None:
        readings = readings.withColumn(PART, bucket)
        extra.append(PART)
    how = {"whole": whole, "bucket": None if whole else F.col(PART)}
    if context:
        extra += [context, "ctx_seed", "ctx_chain", "ctx_accepted"] + [f"ctx_{c}" for c in MOISTURE_FEATURES]
    # a cycle needs a reading: NULL/NaN readings are rejected on ingest
    r = (normalise(readings).filter(~is_missing("soil_moisture"))
         .select(*keys, *order, "hour", "hour_sin", "hour_cos",
                 "soil_temp", "rain_fall", "soil_moisture", *extra))
    complete = ~(is_missing("hour_sin") | is_missing("hour_cos")
                 | is_missing("soil_temp") | is_missing("rain_fall"))
    r = r.withColumns({"_cx_complete": complete})
    p1 = shift(r, keys, order,
               lags={"_cx_prev_ok": ("_cx_complete", 1),
                     "_cx_l5": (order[-1], seed), "_cx_l6": (order[-1], seed + 1)},
               leads={"future_permanent": ("soil_moisture", 1)}, **how)
    is_seed = F.col("_cx_l5").isNull()
    prev_live_ok = F.col("_cx_l6").isNotNull() & F.coalesce(F.col("_cx_prev_ok"), F.lit(False))
    chain = F.when(is_seed | prev_live_ok, F.col("soil_moisture"))
    if context:
        is_seed = F.when(F.col(context), F.col("ctx_seed")).otherwise(is_seed)
        chain = F.when(F.col(context), F.col("ctx_chain")).otherwise(chain)
    p1 = p1.withColumns({"is_seed": is_seed, "chain": chain}).drop("_cx_prev_ok", "_cx_l5", "_cx_l6")
    p2 = shift(p1, keys, order, lags={f"prev_{k}": ("chain", k) for k in range(1, HISTORY + 1)},
               skip_nulls=True, **how)
    # narrowed features and the acceptance flag in one projection
    rounded = {"soil_temp": round_half_even("soil_temp"), "rain_fall": round_half_even("rain_fall")}
    narrowed = {c: float32(rounded.get(c, F.col(c))) for c in MOISTURE_FEATURES}
    accepted = ~F.col("is_seed")
    for c in MOISTURE_FEATURES:
        accepted = accepted & ~is_missing(narrowed[c])
    if context:
        accepted = F.when(F.col(context), F.col("ctx_accepted")).otherwise(accepted)
        narrowed = {c: F.when(F.col(context), F.col(f"ctx_{c}")).otherwise(e) for c, e in narrowed.items()}
    return p2.withColumns({**narrowed, "accepted": accepted}).drop("_cx_complete")


def feature_rows_compat(readings: DataFrame, keys: Sequence[str] = KEYS,
                        order: Sequence[str] = ORDER, **kw) -> DataFrame:
    """The permanent store's live rows: one row per accepted cycle, labelled
    with the next cycle's reading (NULL while pending)."""
    keys, order = list(keys), list(order)
    cyc = compat_cycles(readings, keys, order, **kw)
    return (cyc.filter("accepted")
            .select(*keys, *order, *MOISTURE_FEATURES,
                    F.col("future_permanent").alias(MOISTURE_TARGET)))

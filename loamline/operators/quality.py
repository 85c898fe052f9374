"""Filters, guards and data-quality checks. Failing rows are kept in a
rejects frame with a reason instead of being returned as errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from loamline.functions.scalar import is_missing, truncate_int
from loamline.schemas import LABEL_DOMAIN, MOISTURE_RANGE

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def binary_labels(df: DataFrame, label: str = "Output") -> DataFrame:
    """Rows whose label is 0 or 1 (label 2 and NULL dropped)."""
    return df.filter(F.col(label).isin(*LABEL_DOMAIN))


def complete_rows(cols: Sequence[str]) -> Column:
    """TRUE when none of ``cols`` is NULL or NaN."""
    ok = F.lit(True)
    for c in cols:
        ok = ok & ~is_missing(c)
    return ok


def complete_cases(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``dropna()``: drop rows with a NULL or NaN in any (numeric) column."""
    cols = list(cols or df.columns)
    return df.na.drop("any", subset=cols)


def split_complete(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) by the incomplete-row guard; rejects carry the
    names of the missing columns in ``reason``."""
    flagged = df.withColumn("_q_ok", complete_rows(cols))
    missing = F.concat_ws(",", *[F.when(is_missing(c), F.lit(c)) for c in cols])
    accepted = flagged.filter("_q_ok").drop("_q_ok")
    rejected = (flagged.filter(~F.col("_q_ok")).drop("_q_ok")
                .withColumn("reason", F.concat(F.lit("incomplete: "), missing)))
    return accepted, rejected


def in_range(c: str | Column, lo: float = MOISTURE_RANGE[0], hi: float = MOISTURE_RANGE[1]) -> Column:
    """Inclusive range test that is FALSE for NULL and NaN (Spark orders NaN
    above every number, so NaN must be excluded explicitly)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.between(lo, hi) & ~F.isnan(col), F.lit(False))


def range_check(df: DataFrame, col: str, lo: float = MOISTURE_RANGE[0],
                hi: float = MOISTURE_RANGE[1]) -> DataFrame:
    """Flag each row ``valid`` (inside [lo, hi]) and give a reason otherwise."""
    c = F.col(col)
    reason = (F.when(c.isNull(), F.lit("null")).when(F.isnan(c), F.lit("nan"))
              .when(c < lo, F.lit("below")).when(c > hi, F.lit("above")))
    return df.withColumn("valid", in_range(col, lo, hi)).withColumn("reason", reason)


def valid_labels(df: DataFrame, col: str) -> DataFrame:
    """Truncate a prediction to int and flag membership of {0, 1}."""
    v = truncate_int(col)
    return df.withColumn("label_int", v).withColumn(
        "valid", F.coalesce(v.isin(*LABEL_DOMAIN), F.lit(False)))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per column: NULL, NaN and infinite counts, in one scan. Columns
    that are not numbers have no NaN or infinity."""
    cols = list(cols or df.columns)
    aggs = []
    for c in cols:
        x = F.col(c)
        number = isinstance(df.schema[c].dataType, _NUMERIC)
        aggs += [F.count_if(x.isNull()).alias(f"{c}__null"),
                 (F.count_if(F.isnan(x.cast("double"))) if number else F.lit(0).cast("long")).alias(f"{c}__nan"),
                 (F.count_if(F.abs(x.cast("double")) == float("inf")) if number
                  else F.lit(0).cast("long")).alias(f"{c}__inf")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__null`, `{c}__nan`, `{c}__inf`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, n_null, n_nan, n_inf)")


class FrameContractError(ValueError):
    """A training or scoring frame does not have the agreed columns."""


def check_frame(df: DataFrame, features: Sequence[str], target: str | None = None) -> None:
    """Schema contract of a training/scoring frame; only the schema is read.

    Raises on a missing target, missing or unexpected feature columns, and
    non-numeric columns. Keys ``id``/``station_id``/``event_id``/``ts`` are
    ignored.
    """
    ignore = {"id", "station_id", "event_id", "ts", "sample_id"}
    names = [f.name for f in df.schema.fields if f.name not in ignore]
    if target is not None and target not in names:
        raise FrameContractError(f"missing target column {target!r}")
    incoming = set(names) - ({target} if target else set())
    missing = set(features) - incoming
    extra = incoming - set(features)
    if missing:
        raise FrameContractError(f"missing feature columns: {sorted(missing)}")
    if extra:
        raise FrameContractError(f"unexpected columns: {sorted(extra)}")
    bad = [f.name for f in df.schema.fields
           if f.name in incoming | ({target} if target else set())
           and not isinstance(f.dataType, _NUMERIC)]
    if bad:
        raise FrameContractError(f"non-numeric columns: {bad}")


def check_values(df: DataFrame, cols: Sequence[str]) -> None:
    """Value contract: non-empty, no NULL/NaN, no infinity -- one aggregation
    pass over the frame, one row back to the driver."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count_if(x.isNull() | F.isnan(x)).alias(f"{c}__missing"),
                 F.count_if(F.abs(x) == float("inf")).alias(f"{c}__inf")]
    row = df.agg(*aggs).first()
    if not row["_n"]:
        raise FrameContractError("empty frame")
    bad = [c for c in cols if row[f"{c}__missing"]]
    if bad:
        raise FrameContractError(f"missing values in columns: {bad}")
    if any(row[f"{c}__inf"] for c in cols):
        raise FrameContractError("infinite values")

"""Column-level helpers. All are built-in expressions, so they stay inside
whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_sin(hour: ColumnOrName) -> Column:
    """sin(2*pi*hour/24), evaluated left to right like the reference."""
    return F.sin(F.lit(2 * math.pi) * _c(hour) / F.lit(24))


def hour_cos(hour: ColumnOrName) -> Column:
    return F.cos(F.lit(2 * math.pi) * _c(hour) / F.lit(24))


def round_half_even(x: ColumnOrName, digits: int = 2) -> Column:
    """NumPy-style rounding of a double: scale, round half to even, unscale.

    ``F.round`` is half-up and ``F.bround`` works on the decimal value, so both
    differ from NumPy on inputs such as 1.015 (NumPy gives 1.01).
    """
    scale = F.lit(float(10 ** digits))
    return F.rint(_c(x) * scale) / scale


def float32(x: ColumnOrName) -> Column:
    """Narrow a double to float32 and widen it again (0.1 -> 0.10000000149...)."""
    return _c(x).cast("float").cast("double")


def to_number(x: ColumnOrName) -> Column:
    """Text to double; unparsable text gives NULL instead of an error."""
    return _c(x).try_cast("double")


def nan_to_null(x: ColumnOrName) -> Column:
    """Spark keeps NaN apart from NULL; the reference treats both as missing."""
    c = _c(x)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def is_missing(x: ColumnOrName) -> Column:
    """NULL or NaN, the pandas notion of a missing number."""
    c = _c(x)
    return c.isNull() | F.isnan(c)


def absolute_error(predicted: ColumnOrName, actual: ColumnOrName) -> Column:
    return F.abs(_c(predicted) - _c(actual))


def truncate_int(x: ColumnOrName) -> Column:
    """Python ``int()`` of a number: truncate toward zero; NULL for NaN and for
    numbers that do not fit."""
    return _c(x).try_cast("int")


def json_number(text: ColumnOrName, field: str) -> Column:
    """Numeric member of a JSON object string, NULL when absent or not numeric."""
    return F.get_json_object(_c(text), f"$.{field}").try_cast("double")

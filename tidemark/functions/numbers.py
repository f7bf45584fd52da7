"""Numeric casts, rounding and bucketing."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal notation with an optional exponent. Spark's own cast is wider: it reads
# '12d' as 12.0 and lets NaN and Infinity through.
NUMBER_PATTERN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def is_number(col: Column) -> Column:
    return col.rlike(NUMBER_PATTERN)


def to_double(col: Column, default: float | None = None) -> Column:
    """Number text to double; anything else is null, or ``default``."""
    value = F.when(is_number(col), F.trim(col).try_cast("double"))
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def to_long(col: Column) -> Column:
    """Number text to long, cutting off decimals; anything else is null."""
    return to_double(col).try_cast("long")


def to_bool(col: Column) -> Column:
    return col.try_cast("boolean")


def round_even(col: Column, digits: int) -> Column:
    """Round half to even."""
    return F.bround(col, digits)


def round_away(col: Column, digits: int) -> Column:
    """Round half away from zero."""
    return F.round(col, digits)


def to_millions(col: Column) -> Column:
    """Units to whole millions, half to even."""
    return F.bround(col / F.lit(1e6), 0).cast("long")


def from_millions(col: Column) -> Column:
    return (col * F.lit(1_000_000)).cast("long")


def ladder(
    value: Column,
    steps: Sequence[tuple[Any, Any]],
    otherwise: Any,
    dtype: str | None = None,
) -> Column:
    """CASE ladder: the result of the first ``(lower bound, result)`` that ``value`` reaches."""
    out: Column | None = None
    for bound, result in steps:
        test = value >= F.lit(bound)
        out = F.when(test, F.lit(result)) if out is None else out.when(test, F.lit(result))
    out = F.lit(otherwise) if out is None else out.otherwise(F.lit(otherwise))
    return out.cast(dtype) if dtype else out


def size_bucket(
    col: Column,
    small_below: float = 10_000,
    medium_up_to: float = 30_000,
    labels: tuple[str, str, str, str] = ("Small", "Medium", "Large", "Unknown"),
) -> Column:
    """Three size classes, and a fourth label for null."""
    small, medium, large, unknown = labels
    return (
        F.when(col.isNull(), F.lit(unknown))
        .when(col < small_below, F.lit(small))
        .when(col <= medium_up_to, F.lit(medium))
        .otherwise(F.lit(large))
    )


def stock_status(units: Column, reorder_level: Column) -> Column:
    return (
        F.when(units == 0, F.lit("Out of Stock"))
        .when(units <= reorder_level, F.lit("Low Stock"))
        .otherwise(F.lit("In Stock"))
    )

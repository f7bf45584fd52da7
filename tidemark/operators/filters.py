"""Filters put together from optional parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cohort(
    df: DataFrame,
    any_of: Sequence[tuple[str, Any]],
    between: tuple[str, Any, Any] | None = None,
    above: tuple[str, Any] | None = None,
) -> DataFrame:
    """Rows where one of the ``(column, value)`` pairs holds, a column lies in a closed
    range and a metric exceeds a threshold; a null never satisfies a condition."""
    keep = reduce(lambda a, b: a | b, [F.col(c) == F.lit(v) for c, v in any_of])
    if between:
        keep = keep & F.col(between[0]).between(between[1], between[2])
    if above:
        keep = keep & (F.col(above[0]) > F.lit(above[1]))
    return df.filter(keep)


def filter_given(
    df: DataFrame,
    equals: Mapping[str, Any] | None = None,
    at_least: Mapping[str, Any] | None = None,
    at_most: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Apply only those conditions whose argument is not None."""
    tests: list[Column] = []
    tests += [F.col(c) == F.lit(v) for c, v in (equals or {}).items() if v is not None]
    tests += [F.col(c) >= F.lit(v) for c, v in (at_least or {}).items() if v is not None]
    tests += [F.col(c) <= F.lit(v) for c, v in (at_most or {}).items() if v is not None]
    for test in tests:
        df = df.filter(test)
    return df


def semi_cohort(df: DataFrame, members: DataFrame, on: str, member_key: str) -> DataFrame:
    """Rows whose key is among the keys of ``members``."""
    keys = members.select(F.col(member_key).alias("_key"))
    return df.join(keys, F.col(on) == F.col("_key"), "left_semi")

"""Unions by name and exact table comparison."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def table_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``copies`` = new minus old.

    One aggregation over the tagged union; both tables have the same columns.
    """
    columns = old.columns
    tagged = old.withColumn("_n", F.lit(-1)).unionByName(
        new.select(*columns).withColumn("_n", F.lit(1))
    )
    return (
        tagged.groupBy(*columns)
        .agg(F.sum("_n").alias("copies"))
        .filter(F.col("copies") != 0)
    )


def tables_equal(old: DataFrame, new: DataFrame) -> bool:
    if set(old.columns) != set(new.columns):
        return False
    return table_diff(old, new).isEmpty()

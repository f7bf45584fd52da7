"""Star schema builders: surrogate keys, dimension, facts, rollup and latest view."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import from_millions, round_even
from tidemark.functions.text import label
from tidemark.operators.mapping import look_up
from tidemark.operators.ordered import dense_sequence
from tidemark.operators.rows import first_non_null, last_non_null


def surrogate_keys(
    df: DataFrame, natural: str, key: str, prefix: str = "COMP", width: int = 3
) -> DataFrame:
    """One row per distinct natural key (null has none) with a key numbered in name order."""
    names = df.select(natural).filter(F.col(natural).isNotNull()).distinct()
    return dense_sequence(names, [natural], "_n").select(
        natural, label(prefix, F.col("_n"), width).alias(key)
    )


def build_dimension(
    df: DataFrame,
    keys: DataFrame,
    natural: str,
    key: str,
    attributes: Sequence[str],
    order: Sequence[str | Column],
    name: str | None = None,
) -> DataFrame:
    """One row per natural key with the first non-null value of each attribute."""
    rows = df.filter(F.col(natural).isNotNull())
    members = first_non_null(rows, [natural], attributes, order)
    return look_up(members, keys, natural, [key]).select(
        key, F.col(natural).alias(name or natural), *attributes
    )


def build_fact(df: DataFrame, keys: DataFrame, natural: str, key: str, columns: Sequence[str]) -> DataFrame:
    """The named columns, with the natural key replaced by the surrogate key that is put
    at its place in ``columns``."""
    return look_up(df, keys, natural, [key]).select(*columns)


def build_observations(
    df: DataFrame,
    keys: DataFrame,
    natural: str,
    key: str,
    metric: str,
    order: Sequence[str | Column],
    columns: Mapping[str, str],
    prefix: str = "ARR",
    width: int = 4,
    observation: str = "observation_id",
) -> DataFrame:
    """One row per non-null metric, numbered in ``order``.

    ``columns`` maps source to output names. The metric is given in millions
    (``<metric>``) and in units (``<metric without _M>``). ``_seq`` keeps the order.
    """
    rows = df.filter(F.col(metric).isNotNull())
    numbered = look_up(dense_sequence(rows, order, "_seq"), keys, natural, [key])
    units = metric.removesuffix("_M")
    return numbered.select(
        label(prefix, F.col("_seq"), width).alias(observation),
        *[F.col(c).alias(n) for c, n in columns.items()],
        key,
        F.col(metric),
        from_millions(F.col(metric)).alias(units),
        "_seq",
    )


def quarterly_rollup(
    observations: DataFrame,
    dim: DataFrame,
    key: str,
    metric: str,
    order: Sequence[str | Column],
    period: Sequence[str] = ("observation_year", "observation_quarter"),
    attributes: Sequence[str] = ("company_name", "industry"),
) -> DataFrame:
    """Count, latest, mean (1 digit, half to even), max and min per member and period.

    Rows without a full key are left out. The dimension is joined after the aggregation.
    """
    keys = [key, *period]
    rolled = last_non_null(
        observations.dropna(subset=keys),
        keys,
        [metric],
        order,
        F.count("*").alias("observations_count"),
        round_even(F.avg(metric), 1).alias(f"avg_{metric}"),
        F.max(metric).alias(f"max_{metric}"),
        F.min(metric).alias(f"min_{metric}"),
    ).withColumnRenamed(metric, f"latest_{metric}")
    return look_up(rolled, dim, key, attributes).select(
        *keys,
        "observations_count",
        *[f"{f}_{metric}" for f in ("latest", "avg", "max", "min")],
        *attributes,
    )


def latest_view(
    observations: DataFrame,
    dim: DataFrame,
    key: str,
    order: Sequence[str | Column],
    columns: Mapping[str, str],
    attributes: Sequence[str],
    count: str = "total_observations_recorded",
    count_default: int | None = None,
) -> DataFrame:
    """Every member with its latest non-null values and its number of observations.

    ``columns`` maps observation columns to output names. Members without observations
    stay; their count is ``count_default``. An order value of null comes first, so an
    undated observation never counts as the latest.
    """
    latest = last_non_null(observations, [key], list(columns), order, F.count("*").alias(count))
    wide = look_up(
        dim.select(key, *attributes), latest, key, {**columns, count: count}
    )
    if count_default is not None:
        wide = wide.withColumn(count, F.coalesce(count, F.lit(count_default).cast("long")))
    return wide

"""Row selection: first or last row per key, distinct rows, bounded results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _order_struct(order: Sequence[str | Column]) -> Column:
    return F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], by) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(by(F.struct(*rest), _order_struct(order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in an explicit order (null sorts first).

    An aggregate, so every task sends at most one row per key and a hot key costs nothing.
    """
    return _pick(df, keys, order, F.min_by)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The last row of each key in an explicit order (null sorts first)."""
    return _pick(df, keys, order, F.max_by)


def first_non_null(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """Per key, the first non-null value of each column, chosen column by column."""
    place = _order_struct(order)
    return df.groupBy(*keys).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in columns]
    )


def last_non_null(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order: Sequence[str | Column],
    *extra: Column,
) -> DataFrame:
    """Per key, the last non-null value of each column; ``extra`` aggregates ride along."""
    place = _order_struct(order)
    return df.groupBy(*keys).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in columns], *extra
    )


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The ``k`` best rows per group with their rank. Spark limits each group to ``k``
    rows before the shuffle, so a hot group never reaches one task whole."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def top(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The ``k`` first rows of an order (a top-k node, not a full sort)."""
    return df.orderBy(*order).limit(k)


def bounded(df: DataFrame, rows: int | None = None, default: int = 50, cap: int = 100) -> DataFrame:
    """Clamp an interactive result: ``default`` rows when none are asked for, never more
    than ``cap``."""
    return df.limit(default if rows is None else min(rows, cap))

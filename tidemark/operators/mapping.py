"""Value mapping, membership flags and dimension look-ups."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import skewed_join

# Mappings up to this many entries become a literal in the projection; longer ones are
# joined as a table.
LITERAL_LIMIT = 200


def mapped(col: Column, mapping: Mapping[str, str]) -> Column:
    """Exact-match replacement; unknown values pass through and null stays null."""
    if not mapping:
        return col
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), col), col)


def map_values(
    df: DataFrame,
    column: str,
    mapping: Mapping[str, str] | DataFrame,
    output: str | None = None,
) -> DataFrame:
    """Replace the values of ``column`` by a dictionary or a two-column table.

    A table is joined; whether it is broadcast is left to Spark's own size check, and the rows
    of hot values are spread where it is not.
    """
    output = output or column
    if isinstance(mapping, Mapping):
        if len(mapping) <= LITERAL_LIMIT:
            return df.withColumn(output, mapped(F.col(column), mapping))
        from tidemark.session import inline_table

        mapping = inline_table(
            df.sparkSession, {"raw": list(mapping), "canonical": list(mapping.values())}
        )
    raw, canonical = mapping.columns[:2]
    table = mapping.groupBy(F.col(raw).alias("_raw")).agg(F.min(canonical).alias("_canonical"))
    joined = skewed_join(df.withColumn("_raw", F.col(column)), table, ["_raw"])
    return joined.withColumn(output, F.coalesce("_canonical", F.col(column))).drop(
        "_raw", "_canonical"
    )


def flag_members(
    df: DataFrame, column: str, members: DataFrame | Iterable, output: str
) -> DataFrame:
    """True where the value is a member of the list or of the first column of a table;
    null is no member."""
    if not isinstance(members, DataFrame):
        return df.withColumn(output, F.coalesce(F.col(column).isin(list(members)), F.lit(False)))
    keys = members.select(F.col(members.columns[0]).alias("_member")).distinct()
    joined = skewed_join(
        df.withColumn("_member", F.col(column)), keys.withColumn("_found", F.lit(True)), ["_member"]
    )
    return joined.withColumn(output, F.col("_found").isNotNull()).drop("_member", "_found")


def look_up(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    columns: Sequence[str] | Mapping[str, str],
    dim_key: str | None = None,
) -> DataFrame:
    """Left equi-join that brings ``columns`` (or ``{dim column: new name}``) of ``dim``.

    ``dim`` has one row per key. Only the needed columns are joined. AQE splits the rows
    of a hot key where ``dim`` is too big to be broadcast.
    """
    names = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    side = dim.select(
        F.col(dim_key or key).alias("_key"), *[F.col(c).alias(n) for c, n in names.items()]
    )
    return df.join(side, F.col(key) == F.col("_key"), "left").drop("_key")

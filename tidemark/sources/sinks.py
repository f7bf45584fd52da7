"""Sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Overwrite a table; CSV gets a header, and keeps white space around values."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_bundle(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """Write named tables side by side; returns name -> path."""
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in tables}
    for name, df in tables.items():
        write_table(df, paths[name], fmt)
    return paths


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_vectors(df: DataFrame, path: str, vector: str = "embedding") -> None:
    """Vectors as a Parquet column of array<float>."""
    df.withColumn(vector, F.col(vector).cast("array<float>")).write.mode("overwrite").parquet(path)


def append_dead_letters(letters: DataFrame, path: str, batch: int | None = None) -> None:
    """Append quarantine records as JSON, by day of ingestion. The records of a numbered batch
    have a folder of their own, so that a batch that is written again counts once."""
    dated = letters.withColumn("ingest_date", F.to_date("quarantined_at"))
    if batch is None:
        dated.write.mode("append").partitionBy("ingest_date").json(path)
    else:
        dated.write.mode("overwrite").partitionBy("ingest_date").json(f"{path}/batch={batch}")


def fingerprint(df: DataFrame, *by: str) -> DataFrame:
    """The number of rows and two sums of row hashes, per group of ``by``. Tables with the same
    rows have the same fingerprint in whatever order; others differ but for 1 in 2^128."""
    cells = [c for c in df.columns if c not in by]
    row = [*cells, *[F.isnull(c) for c in cells]]
    whole = F.lit(str(2**64)).cast("decimal(38,0)")
    sums = [
        F.pmod(F.sum(F.xxhash64(*row, F.lit(salt)).cast("decimal(38,0)")), whole).cast("string")
        for salt in (1, 2)
    ]
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), *[F.coalesce(s, F.lit("0")).alias(n) for s, n in zip(sums, ("high", "low"))]
    )


FINGERPRINT = "rows LONG, high STRING, low STRING"


def stored_fingerprint(spark: SparkSession, path: str) -> tuple | None:
    """The fingerprint that was stored with the snapshot at ``path``."""
    from tidemark.sources.readers import read_or_empty

    row = read_or_empty(spark, f"{path}/_fingerprint", FINGERPRINT).first()
    return None if row is None else tuple(row)


def write_snapshot(df: DataFrame, path: str, print_: tuple) -> None:
    """Overwrite a snapshot and store its fingerprint with it, last."""
    write_table(df, path)
    spark = df.sparkSession
    spark.createDataFrame([print_], FINGERPRINT).coalesce(1).write.mode("overwrite").parquet(f"{path}/_fingerprint")


def write_if_changed(df: DataFrame, path: str) -> tuple[bool, int]:
    """Overwrite the snapshot at ``path`` only if its rows differ; ``(changed, rows)``.
    The old rows are not read, only their fingerprint.

    ``df`` must not read from ``path``.
    """
    from tidemark.session import durable, forget

    fresh = durable(df, "snapshot")
    print_ = tuple(fingerprint(fresh).first())
    changed = stored_fingerprint(df.sparkSession, path) != print_
    if changed:
        write_snapshot(fresh, path, print_)
    forget(fresh)
    return changed, print_[0]

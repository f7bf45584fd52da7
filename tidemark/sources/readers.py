"""Readers for raw files. Schemas are given, never inferred over the data."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Name endings and beginnings of output files that may lie in an input folder.
OUTPUT_SUFFIXES = ("_clean.csv", "_arr.csv", "_enriched.csv")
OUTPUT_PREFIXES = ("dim_", "fct_", "agg_", "view_")
ORDER = ("_file", "_block", "_row")
_ORDER_TYPES = [T.StructField(n, t) for n, t in zip(ORDER, (T.StringType(), T.LongType(), T.LongType()))]


class MissingColumns(ValueError):
    """A table lacks columns it must have."""


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "table") -> DataFrame:
    """Raise with the missing names, or hand the table on. Looks at the schema only."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise MissingColumns(f"{what} lacks required columns: {', '.join(missing)}")
    return df


def strings(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def file_order(df: DataFrame) -> DataFrame:
    """Add ``_file``, ``_block`` and ``_row``: ordered together they give the line order
    of the files, whatever way Spark packs them into tasks."""
    return df.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_row": F.monotonically_increasing_id(),
        }
    )


def _listed(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Files in a folder, by name. Spark lists them; their content is not read."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    except AnalysisException:
        return []
    return sorted(r[0] for r in files.select("path").collect())


def read_csv_folder(
    spark: SparkSession,
    folder: str,
    skip_prefixes: Sequence[str] = OUTPUT_PREFIXES,
    skip_suffixes: Sequence[str] = OUTPUT_SUFFIXES,
    null_value: str | None = None,
    ordered: bool = False,
) -> DataFrame:
    """All CSV files of a folder but known outputs, as text columns.

    ``folder`` may end in ``/*``, so that tables which Spark wrote, folders of files, are read or
    skipped by the names of their folders. Files with one header are scanned together; differing
    headers are united by name, and columns a file lacks are null. No file raises
    ``FileNotFoundError``.
    """
    base = re.sub(r"^\w+:/+", "/", folder).split("*")[0].rstrip("/")

    def keep(path: str) -> bool:
        below = unquote(path).partition(f"{base}/")[2] or path.rsplit("/", 1)[-1]
        return not any(
            name.startswith(tuple(skip_prefixes)) or name.endswith(tuple(skip_suffixes)) for name in below.split("/")
        )

    paths = [p for p in _listed(spark, folder, "*.csv") if keep(p)]
    if not paths:
        raise FileNotFoundError(f"no raw CSV file in {folder}")
    groups = headers(spark, paths)
    parts = [read_csv(spark, group, header, null_value, ordered) for header, group in groups.items()]
    if not parts:
        raise FileNotFoundError(f"no header in any raw CSV file in {folder}")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each header, in the order of their names. One job looks at the lines of all
    files, unparsed; the driver gets a line per file. A file without lines has no header, and a
    header has no line breaks."""
    lines = file_order(spark.read.text(list(paths))).filter("_block = 0")
    first = lines.groupBy("_file").agg(F.min_by("value", "_row").alias("line")).collect()
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in sorted(first, key=lambda r: r._file):
        header = tuple(next(csv.reader([r.line.removeprefix("\ufeff")]), ()))
        # the metadata column gives the path as a URL
        groups.setdefault(header, []).append(unquote(r._file))
    return groups


def read_fields(spark: SparkSession, paths: Sequence[str], fields: Sequence[str], line_breaks: bool = True) -> DataFrame:
    """CSV files with any columns in any order, as ``fields`` bound by the header of each file,
    and the order columns. An empty cell is '', a field the header lacks is null. Without
    ``line_breaks`` in quoted cells a large file is read by many tasks."""
    parts = []
    for header, group in headers(spark, paths).items():
        cells = read_csv(spark, group, [f"_c{i}" for i in range(len(header))], ordered=True, line_breaks=line_breaks)
        parts.append(
            cells.select(
                *[
                    F.coalesce(f"_c{header.index(f)}", F.lit("")).alias(f) if f in header else F.lit(None).cast("string").alias(f)
                    for f in fields
                ],
                *ORDER,
            )
        )
    out = spark.createDataFrame([], T.StructType([*strings(fields), *_ORDER_TYPES])) if not parts else parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    null_value: str | None = None,
    ordered: bool = False,
    line_breaks: bool = True,
) -> DataFrame:
    """CSV with a header, as text. Quoted fields may hold line breaks; ``null_value`` is
    the text that means null (without it such text is kept)."""
    reader = spark.read.schema(strings(columns)).options(header=True, multiLine=line_breaks, escape='"')
    reader = reader.option("maxColumns", max(20480, len(columns)))
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    df = reader.csv(paths if isinstance(paths, str) else list(paths))
    return file_order(df) if ordered else df


def read_typed_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, null_value: str | None = None
) -> DataFrame:
    """CSV with a header and a declared schema; a value that does not fit becomes null."""
    reader = spark.read.schema(schema).options(header=True, multiLine=True, escape='"')
    return (reader.option("nullValue", null_value) if null_value is not None else reader).csv(path)


def read_json_lines(spark: SparkSession, path: str, columns: Sequence[str], ordered: bool = False) -> DataFrame:
    """JSON lines as text columns; blank lines are skipped."""
    df = spark.read.schema(strings(columns)).json(path)
    df = file_order(df) if ordered else df
    # a blank line reads as a row without any value
    return df.dropna("all", subset=list(columns))


def read_keyed_json(
    spark: SparkSession, path: str, key: str, schema: T.StructType | str, lines: bool = False
) -> DataFrame:
    """An object of objects, ``{key: {attributes}}``: one row per key. A file is one object, or with
    ``lines`` each of its lines is one, so that a large file is read by many tasks."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    whole = spark.read.text(path, wholetext=not lines)
    parsed = F.from_json("value", T.MapType(T.StringType(), schema))
    return whole.select(F.explode(parsed).alias(key, "_v")).select(key, "_v.*")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", **options) -> DataFrame:
    """A table, or an empty one of the same schema where the path does not exist."""
    try:
        return spark.read.schema(schema).options(**options).format(fmt).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def empty_as_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    names = list(columns or df.columns)
    return df.withColumns({c: F.when(F.col(c) != "", F.col(c)) for c in names})


def register(tables: Mapping[str, DataFrame]) -> None:
    """Make tables known to ``spark.sql`` by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)

"""Column profiles, lineage edges and impact analysis."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.compare import union_all
from tidemark.operators.rows import top_per_group
from tidemark.session import durable, inline_table

_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def _as_text(field: T.StructField) -> Column:
    col = F.col(f"`{field.name}`")
    return F.to_json(col) if isinstance(field.dataType, _NESTED) else col.cast("string")


def _smallest_texts(df: DataFrame, k: int) -> DataFrame:
    """The ``k`` smallest different values of each column: ``i``, ``sample_values``. A task keeps
    ``k`` values of a column and compares each batch with the largest of them."""
    texts = df.select(*[_as_text(f).alias(f"c{i}") for i, f in enumerate(df.schema.fields)])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, pa.Array] = {}
        for batch in batches:
            for i, column in enumerate(batch.columns):
                values = column.cast(pa.string()).drop_null()
                best = kept.get(i, values[:0])
                if len(best) == k:
                    values = values.filter(pc.less(values, best[k - 1]))
                if len(values):
                    found = pa.concat_arrays([best, values]).unique()
                    kept[i] = found.take(pc.array_sort_indices(found)[:k])
        places = [pa.array([i] * len(best), pa.int32()) for i, best in kept.items()]
        if places:
            columns = [pa.concat_arrays(places), pa.concat_arrays(kept.values())]
            yield pa.RecordBatch.from_arrays(columns, ["i", "v"])

    found = texts.mapInArrow(keep, "i int, v string").distinct()
    smallest = top_per_group(found, ["i"], [F.col("v")], k)
    return smallest.groupBy("i").agg(F.sort_array(F.collect_list("v")).alias("sample_values"))


def profile_columns(df: DataFrame, table: str, samples: int = 3) -> DataFrame:
    """One row per column: type, nulls, distinct values, the smallest sample values (as
    text) and the table's size. An empty table gives no rows.

    Values are counted by a hash of 128 bits, map-side first, so no text is shuffled or written
    and a hot value is one row; distinct counts are exact but for collisions. ``df`` is read
    twice, for the counts and for the samples.
    """
    fields = df.schema.fields

    def cell(i: int, field: T.StructField) -> Column:
        text = _as_text(field)
        hashes = [F.when(text.isNotNull(), F.xxhash64(F.lit(seed), text)) for seed in (1, 2)]
        return F.struct(F.lit(i).alias("i"), hashes[0].alias("a"), hashes[1].alias("b"))

    cells = F.explode(F.array(*[cell(i, f) for i, f in enumerate(fields)])).alias("c")
    counts = df.select(cells).groupBy("c.i", "c.a", "c.b").agg(F.count("*").alias("n"))
    totals = counts.groupBy("i").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("a").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("a").alias("distinct_count"),
    )
    sampled = _smallest_texts(df, samples)
    types = inline_table(
        df.sparkSession,
        {
            "i": range(len(fields)),
            "column_name": [f.name for f in fields],
            "data_type": [f.dataType.simpleString() for f in fields],
        },
    ).withColumn("i", F.col("i").cast("int"))
    return totals.join(sampled, "i", "left").join(types, "i").select(
        F.lit(table).alias("table_name"),
        "column_name",
        "data_type",
        (F.col("null_count") > 0).alias("nullable"),
        "null_count",
        "distinct_count",
        F.coalesce("sample_values", F.array().cast("array<string>")).alias("sample_values"),
        "row_count",
        F.lit(len(fields)).cast("long").alias("column_count"),
    )


def profile_tables(tables: Mapping[str, DataFrame], samples: int = 3) -> DataFrame:
    return union_all([profile_columns(df, name, samples) for name, df in tables.items()])


def profile_quick(df: DataFrame, table: str, relative_error: float = 0.02) -> DataFrame:
    """Column profile in one pass without shuffling values; distinct counts are
    HyperLogLog estimates and the only sample is the smallest value."""
    fields = df.schema.fields
    parts = [F.count("*").alias("row_count")]
    for i, f in enumerate(fields):
        text = _as_text(f)
        parts += [
            F.count(F.when(text.isNull(), 1)).alias(f"null_{i}"),
            F.approx_count_distinct(text, relative_error).alias(f"distinct_{i}"),
            F.min(text).alias(f"min_{i}"),
        ]
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"null_{i}").alias("null_count"),
            F.col(f"distinct_{i}").alias("distinct_count"),
            F.array_compact(F.array(f"min_{i}")).alias("sample_values"),
        )
        for i, f in enumerate(fields)
    ]
    spread = df.agg(*parts).filter("row_count > 0").select("row_count", F.explode(F.array(*rows)).alias("r"))
    return spread.select(
        F.lit(table).alias("table_name"), "r.column_name", "r.data_type",
        (F.col("r.null_count") > 0).alias("nullable"), "r.null_count", "r.distinct_count",
        "r.sample_values", "row_count", F.lit(len(fields)).cast("long").alias("column_count"),
    )


def lineage_edges(spark: SparkSession, flows: Sequence[Mapping]) -> DataFrame:
    """Edges of a declared flow: ``{"domain", "stages": [[nodes], [nodes], ...]}``. Every
    node of a stage feeds every node of the next."""
    rows = [
        (flow["domain"], source, target, i)
        for flow in flows
        for i, (left, right) in enumerate(zip(flow["stages"], flow["stages"][1:], strict=False))
        for source in left
        for target in right
    ]
    names = ("domain", "source", "target", "stage")
    return inline_table(spark, {n: [r[i] for r in rows] for i, n in enumerate(names)})


def reachable(
    edges: DataFrame, start: DataFrame | Iterable, upstream: bool = False,
    source: str = "source", target: str = "target",
) -> DataFrame:
    """All nodes downstream (or upstream) of the start nodes with their distance.

    Breadth first: each round joins the edges with the nodes found last and is written
    down, so the plan does not grow and cycles end.
    """
    tail, head = (target, source) if upstream else (source, target)
    links = edges.select(F.col(tail).alias("_from"), F.col(head).alias("node")).distinct()
    links = durable(links, "links")
    if not isinstance(start, DataFrame):
        start = inline_table(edges.sparkSession, {"node": list(start)})
    frontier = start.select(F.col(start.columns[0]).alias("node")).distinct()
    found = frontier.withColumn("distance", F.lit(0))
    distance = 0
    while True:
        distance += 1
        step = links.join(frontier.withColumnRenamed("node", "_from"), "_from").select("node").distinct()
        frontier = durable(step.join(found, "node", "left_anti"), "reach")
        if frontier.isEmpty():
            return found.filter("distance > 0")
        found = found.unionByName(frontier.withColumn("distance", F.lit(distance)))

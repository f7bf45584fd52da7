"""Exact duplicates by sorting content.

Texts are normalised (every run of white space becomes one space), sampled splitters deal the
rows into ranges of the normalised text, each range is sorted externally, so that equal texts
lie next to each other, and neighbours are compared in full. The row with the smallest
identifier stays. Texts are shuffled once; counting and marking happen in the sorted ranges.
Splitters are made of a text's first characters and a hash of the whole, so that the sample that
the driver sorts has rows of bounded size; texts with one beginning are still split.

A text that a large share of the rows have would fill one range. Such texts are seen in a
bounded sample of rows, and their rows are dealt by a salt made from the identifier next to the
text. Their smallest identifiers and their sizes come from a count beside the sort, and the part
that the smallest identifier was dealt to keeps its first row. Sorted texts are not written in
between. The sample only chooses how rows are dealt; the result is exact whatever it holds.

Defined results: a null text equals an empty one. Null identifiers come last, so such a row
stays only where its text has no other; of rows with one identifier and one text, exactly one
is kept. An empty table gives an empty result. Input columns whose names equal a result column
are replaced by it. Very long texts are compared whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import ROW, SPACE, quoted, text_of, unpacked
from tidemark.session import durable

SAMPLE_ROWS = 20_000  # rows sampled to see hot texts
HOT_SHARE = 0.001  # a text is dealt by salt from this share of the sample on
SALTS = 256
LEAD = 32  # characters of a text in a splitter


def normalised(text: str) -> Column:
    return F.regexp_replace(text_of(text), SPACE, " ")


def hot_texts(texts: DataFrame, column: str = "_norm") -> list[str]:
    """Digests of texts that hold ``HOT_SHARE`` of a bounded sample: at most 2,000."""
    rows = texts.count()
    share = min(1.0, SAMPLE_ROWS / rows) if rows else 1.0
    sample = texts.sample(share, seed=7).select(F.sha2(column, 256).alias("digest"))
    least = max(3, int(HOT_SHARE * min(rows, SAMPLE_ROWS)))
    found = sample.groupBy("digest").count().filter(F.col("count") >= least)
    return sorted(r.digest for r in found.limit(int(2 / HOT_SHARE)).collect())


def grouped(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Every row with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    ``keep`` names the input columns wanted next to the result (all if left out); they travel
    with the normalised text.
    """
    wanted = docs.columns if keep is None else keep
    rows = docs.select(
        F.struct(*[F.col(quoted(c)) for c in wanted]).alias(ROW),
        F.col(quoted(key)).alias("_id"),
        normalised(text).alias("_norm"),
    )
    digest = F.sha2("_norm", 256)
    hot = hot_texts(rows)
    salt = F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int")
    rows = rows.withColumn("_salt", F.when(digest.isin(hot), salt).otherwise(0) if hot else F.lit(0))

    # the exchange deals by ranges of the window's first keys, so the window needs no other one
    rows = rows.withColumn("_lead", F.substring("_norm", 1, LEAD)).withColumn("_hash", F.xxhash64("_norm"))
    keys = ["_lead", "_hash", *(["_salt"] if hot else [])]
    ranges = rows.repartitionByRange(*keys)
    run = Window.partitionBy(*keys, "_norm")
    in_order = run.orderBy(F.col("_id").asc_nulls_last())
    local = ranges.select(
        ROW,
        "_id",
        "_salt",
        digest.alias("text_sha256"),
        F.row_number().over(in_order).alias("_place"),
        F.min("_id").over(run).alias("_least"),
        F.count(F.lit(1)).over(run).alias("_size"),
    )
    if not hot:
        return unpacked(_marked(local, F.col("_place") == 1), *RESULT)

    # the hot texts as wholes, added up before the shuffle; at most 2,000 rows
    whole = docs.select(F.col(quoted(key)).alias("_id"), F.sha2(normalised(text), 256).alias("text_sha256"))
    whole = whole.filter(F.col("text_sha256").isin(hot)).groupBy("text_sha256")
    whole = durable(whole.agg(F.min("_id").alias("_all_least"), F.count(F.lit(1)).alias("_all_size")), "hot")
    # the part whose first row stays is that of the smallest identifier
    whole = whole.withColumn("_first", F.pmod(F.xxhash64("_all_least"), F.lit(SALTS)).cast("int"))
    merged = local.join(F.broadcast(whole), "text_sha256", "left")
    first = (F.col("_place") == 1) & (F.col("_salt") == F.coalesce("_first", "_salt"))
    merged = merged.withColumn("_size", F.coalesce("_all_size", "_size")).withColumn(
        "_least", F.when(F.col("_all_size").isNull(), F.col("_least")).otherwise(F.col("_all_least"))
    )
    return unpacked(_marked(merged, first), *RESULT)


RESULT = ("keep_id", "group_size", "kept", "text_sha256")


def _marked(rows: DataFrame, first: Column) -> DataFrame:
    return rows.select(
        ROW,
        F.col("_least").alias("keep_id"),
        F.col("_size").cast("long").alias("group_size"),
        first.alias("kept"),
        "text_sha256",
    )


def distinct_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each distinct normalised text, with the input columns only."""
    packed = docs.select(
        F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"),
        F.col(quoted(key)).alias("id"),
        F.col(quoted(text)).alias("text"),
    )
    return grouped(packed, "id", "text", ["row"]).filter("kept").select("row.*")

"""Token ids on disk as directly addressable codes.

An id is split into chunks, low bits first. The first level holds the first chunk of every id
and a bitmap that says which ids go on; the next level holds the second chunk of those, and so
on. A rank directory over each bitmap (the number of set bits before each block) finds an id's
place on the next level. So any single token is read with one look-up per level, without
decoding its block, and small ids take little room.

The files are Parquet: a row is a segment of at least ``SEGMENT`` tokens (whole documents) with
its keys, where they end, and its levels. Segments lie in ascending key order: a range exchange
on the key deals the rows out, each task sorts its range and encodes it while writing. Texts are
shuffled once and read once more for the range sample. Sequence numbers of tokens (``start``)
are the part's total before plus the place in the part, so nothing is sorted in one task.

Defined results: a null text is an empty one, with the end id only. Null keys come first.
Equal keys are ordered by text; rows that repeat are stored each. An empty table gives no
segment.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.byte_bpe import encoder
from tidemark.llm.common import quoted, text_of
from tidemark.session import inline_table

SEGMENT = 1 << 18
WIDTHS = (8, 8, 16)
BLOCK = 512  # bits of a bitmap for each entry of its rank directory
END = b"\0\0\0\0"  # the end id 0

LEVEL = "array<struct<width:int,chunks:binary,more:binary,ranks:binary>>"


def _kind(width: int) -> str:
    return {8: "<u1", 16: "<u2", 32: "<u4"}[width]


def encode(ids: np.ndarray, widths: Sequence[int] = WIDTHS) -> list[dict]:
    """The levels of unsigned 32-bit ids; widths are 8, 16 or 32 bits and cover 32 in all."""
    levels, rest = [], ids.astype("<u4")
    for width in widths:
        low = rest if width == 32 else rest & np.uint32((1 << width) - 1)
        high = np.zeros_like(rest) if width == 32 else rest >> np.uint32(width)
        more = high != 0
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype="<u4") if len(more) else []
        ranks = np.concatenate([[0], np.cumsum(ones)])[: max(1, len(ones))].astype("<u4")
        levels.append(
            {
                "width": width,
                "chunks": low.astype(_kind(width)).tobytes(),
                "more": bits.tobytes(),
                "ranks": ranks.tobytes(),
            }
        )
        rest = high[more]
        if not len(rest):
            break
    return levels


def access(levels: Sequence[dict], places: np.ndarray) -> np.ndarray:
    """The ids at some places: per level one chunk, one bit, one directory entry and a count of
    the bits of one block up to the place."""
    at = np.asarray(places, "i8")
    out, todo, shift = np.zeros(len(at), "<u4"), np.arange(len(at)), 0
    for level in levels:
        chunks = np.frombuffer(level["chunks"], _kind(level["width"]))
        bits = np.frombuffer(level["more"], "u1")
        ranks = np.frombuffer(level["ranks"], "<u4")
        out[todo] |= chunks[at].astype("<u4") << np.uint32(shift)
        goes_on = (bits[at >> 3] >> (at & 7).astype("u1")) & 1 == 1
        todo, at = todo[goes_on], at[goes_on]
        if not len(todo):
            break
        rank = np.empty(len(at), "i8")
        for k, place in enumerate(at):
            start = place // BLOCK * BLOCK
            block = np.unpackbits(bits[start >> 3 : (place >> 3) + 1], bitorder="little")
            rank[k] = int(ranks[place // BLOCK]) + int(block[: place - start].sum())
        at, shift = rank, shift + level["width"]
    return out


def decode(levels: Sequence[dict]) -> np.ndarray:
    """All ids of a segment."""
    out, at, shift = None, None, 0
    for level in levels:
        chunks = np.frombuffer(level["chunks"], _kind(level["width"])).astype("<u4")
        if out is None:
            out, at = chunks, np.arange(len(chunks))
        else:
            out[at] |= chunks << np.uint32(shift)
        more = np.unpackbits(np.frombuffer(level["more"], "u1"), bitorder="little")
        at = at[more[: len(at)] == 1]
        shift += level["width"]
    return np.zeros(0, "<u4") if out is None else out


def write(
    docs: DataFrame, path: str, vocabulary: str, key: str = "doc_id", text: str = "text"
) -> None:
    """Encode all texts, end id included, and store them in ascending key order."""
    rows = docs.select(F.col(quoted(key)).alias("key"), text_of(text).alias("text"))
    kind = rows.schema["key"].dataType
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("segment", T.IntegerType()),
            T.StructField("first", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("keys", T.ArrayType(kind)),
            T.StructField("ends", T.ArrayType(T.LongType())),
            T.StructField("levels", T.StructType.fromDDL(f"l {LEVEL}")["l"].dataType),
        ]
    )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part = encoder(vocabulary), TaskContext.get().partitionId()
        keys, ends, ids = [], [], bytearray()
        first = number = 0

        def flush(names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
            values = (part, number, first, len(ids) // 4, keys, ends, encode(np.frombuffer(ids, "<u4")))
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, types)], names
            )

        level = pa.list_(
            pa.struct(
                [("width", pa.int32()), ("chunks", pa.binary()), ("more", pa.binary()), ("ranks", pa.binary())]
            )
        )
        names, types = schema.names, None
        for batch in batches:
            types = [
                pa.int32(),
                pa.int32(),
                pa.int64(),
                pa.int64(),
                pa.list_(batch.schema.field(0).type),
                pa.list_(pa.int64()),
                level,
            ]
            for k, value in zip(batch.column(0), batch.column(1)):
                ids += code(value.as_py()) + END
                keys.append(k.as_py())
                ends.append(len(ids) // 4)
                if len(ids) >= 4 * SEGMENT:
                    yield flush(names, types)
                    first, number = first + len(ids) // 4, number + 1
                    keys, ends, ids = [], [], bytearray()
        if keys:
            yield flush(names, types)

    tie = F.xxhash64("text")
    ranges = rows.repartitionByRange("key", tie).sortWithinPartitions("key", "text")
    ranges.mapInArrow(segments, schema).write.parquet(path)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The stored segments with the global number of their first token as ``start``. The driver
    adds up one total for each part of the files."""
    stored = spark.read.parquet(path)
    totals = sorted(stored.groupBy("part").agg(F.sum("n_tokens")).collect())
    before = list(accumulate((n for _, n in totals), initial=0))[: len(totals)]
    offsets = inline_table(
        spark,
        {"part": [p for p, _ in totals], "_before": before},
        part=pa.int32(),
        _before=pa.int64(),
    )
    return stored.join(F.broadcast(offsets), "part").withColumn(
        "start", F.col("_before") + F.col("first")
    ).drop("_before")


def documents(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Per document, from the files: key, number of its first token, tokens, and the checksum
    of its ids as little-endian 32-bit integers."""
    stored = segments(spark, path).select("start", "keys", "ends", "levels")
    schema = T.StructType(
        [
            T.StructField(key, stored.schema["keys"].dataType.elementType),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                start, ends = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
                ids = decode(batch.column(3)[i].as_py()).tobytes()
                begins = [0, *ends[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1)[i].values,
                        pa.array([start + b for b in begins], pa.int64()),
                        pa.array([e - b for b, e in zip(begins, ends)], pa.int64()),
                        pa.array([zlib.crc32(ids[4 * b : 4 * e]) for b, e in zip(begins, ends)], pa.int64()),
                    ],
                    schema.names,
                )

    return stored.mapInArrow(read, schema)


def tokens_at(spark: SparkSession, path: str, positions: DataFrame, column: str = "position") -> DataFrame:
    """The ids at global token numbers, read without decoding segments. Each distinct position
    inside the stored range gives one row."""
    spans = segments(spark, path).select(
        "part", "segment", F.col("start").alias("_start"), (F.col("start") + F.col("n_tokens")).alias("_stop")
    ).withColumn(
        "_bucket",
        F.explode(F.sequence(F.floor(F.col("_start") / SEGMENT), F.floor((F.col("_stop") - 1) / SEGMENT))),
    )
    asked = positions.select(F.col(quoted(column)).cast("long").alias("position")).distinct()
    asked = asked.withColumn("_bucket", F.floor(F.col("position") / SEGMENT))
    inside = (F.col("position") >= F.col("_start")) & (F.col("position") < F.col("_stop"))
    found = asked.join(spans, "_bucket").filter(inside).select(
        "part", "segment", "position", (F.col("position") - F.col("_start")).alias("place")
    )

    def look_up(keys, segment, wanted):
        import pandas as pd

        if not len(segment) or not len(wanted):
            return pd.DataFrame({"position": [], "id": []}).astype("int64")
        levels = list(segment["levels"].iloc[0])
        ids = access(levels, wanted["place"].to_numpy())
        return pd.DataFrame({"position": wanted["position"].to_numpy(), "id": ids.astype("int64")})

    return (
        spark.read.parquet(path)
        .select("part", "segment", "levels")
        .groupBy("part", "segment")
        .cogroup(found.groupBy("part", "segment"))
        .applyInPandas(look_up, "position long, id long")
    )

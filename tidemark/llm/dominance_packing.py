"""Packing token sequences: Martello-Toth dominance reduction, then best fit.

A document becomes one piece, or pieces of ``capacity`` tokens with a shorter first one. What a
piece needs of a sequence is its length only, and there are at most ``capacity`` lengths: the
packing problem of any corpus is a histogram of that many counts. The reduction and the best
fit work on the histogram, many equal pieces at a time, and give patterns: "so many sequences
made of these lengths". Pieces are numbered within their length, and each pattern place takes
a run of those numbers, so that rows find their place by a join. No text is shuffled; pieces
are, as rows of a few numbers.

Numbering is done in parts: a task numbers the pieces of each length that it has cut, and the
counts of the tasks before it are added. So one length that a third of all pieces have is not a
hot group.

Defined results: a null text is an empty one and has the end id only. Rows that repeat are
packed each by itself. An empty table gives an empty result. Input columns other than the key
and the text are not carried.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Mapping
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.byte_bpe import encoder
from tidemark.llm.common import quoted, text_of
from tidemark.session import durable, inline_table

CAPACITY = 2048
END = b"\0\0\0\0"  # the end id 0


def piece_lengths(tokens: int, capacity: int) -> list[int]:
    """Full pieces, with the remainder, if any, first."""
    full, rest = divmod(tokens, capacity)
    return [rest] * (rest > 0) + [capacity] * full


def pieces(
    docs: DataFrame,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of all documents, with ``_task`` and ``_place``: the number of the piece
    among those of its length in its task. ``with_ids`` adds the ids as 32-bit integers."""
    keys = docs.select(F.col(quoted(key)).alias("doc_id"), text_of(text).alias("text"))
    fields = [
        keys.schema["doc_id"],
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("_task", T.IntegerType()),
        T.StructField("_place", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))

    def cut(batches):
        encode, task = encoder(vocabulary), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, "i8")
        for batch in batches:
            owner, rows, ids = [], [], []
            for i, value in enumerate(batch.column(1)):
                tokens = encode(value.as_py()) + END
                start = 0
                for n, length in enumerate(piece_lengths(len(tokens) // 4, capacity)):
                    part = tokens[4 * start : 4 * (start + length)]
                    owner.append(i)
                    rows.append((n, start, length, zlib.crc32(part), task, seen[length]))
                    if with_ids:
                        ids.append(part)
                    seen[length] += 1
                    start += length
            columns = [batch.column(0).take(pa.array(owner, pa.int64()))]
            for values, kind in zip(
                zip(*rows) if rows else [()] * 6,
                (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()),
            ):
                columns.append(pa.array(values, kind))
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return keys.mapInArrow(cut, T.StructType(fields))


class _Pool:
    """Counts by length, with the lengths that are left in order."""

    def __init__(self, counts: Mapping[int, int]):
        self.count = {n: c for n, c in counts.items() if c > 0}
        self.lengths = sorted(self.count)

    def take(self, pattern: tuple[int, ...], times: int) -> None:
        for n in pattern:
            self.count[n] -= times
        for n in set(pattern):
            if not self.count[n]:
                del self.count[n]
                self.lengths.pop(bisect.bisect_left(self.lengths, n))

    def largest(self, room: int, without: tuple[int, ...]) -> int:
        """The largest length within the room once ``without`` is taken; 0 if none."""
        at = bisect.bisect_right(self.lengths, room) - 1
        while at >= 0:
            n = self.lengths[at]
            if self.count[n] > without.count(n):
                return n
            at -= 1
        return 0

    def smallest(self, many: int, without: tuple[int, ...]) -> list[int]:
        found: list[int] = []
        for n in self.lengths:
            found += [n] * min(many, self.count[n] - without.count(n))
            if len(found) >= many:
                break
        return found[:many]

    def times(self, pattern: tuple[int, ...]) -> int:
        return min(self.count[n] // pattern.count(n) for n in set(pattern))


def _dominating(pool: _Pool, w: int, capacity: int) -> tuple[int, ...] | None:
    """A set with an item of length ``w`` that dominates every other feasible set with it.

    With ``a`` the longest item that still fits: the set {w} alone where nothing fits; {w, a}
    where ``a`` fills the rest exactly, where no two further items fit, or where at most two
    fit and ``a`` is at least as long as any fitting two together; {w, a, b} where at most two
    fit and ``b``, the longest next to ``a``, is no shorter than the shorter of any fitting two.
    """
    room = capacity - w
    a = pool.largest(room, (w,))
    if not a:
        return (w,)
    low = pool.smallest(3, (w,))
    if a == room or len(low) < 2 or low[0] + low[1] > room:
        return (w, a)
    if len(low) == 3 and sum(low) <= room:
        return None
    best = shorter = 0
    for d in reversed(pool.lengths):
        if 2 * d > room or pool.count[d] <= (w,).count(d):
            continue
        partner = pool.largest(room - d, (w, d))
        if partner >= d:
            best, shorter = max(best, d + partner), max(shorter, d)
    if a >= best:
        return (w, a)
    b = pool.largest(room - a, (w, a))
    return (w, a, b) if b and b >= shorter else None


def reduced(
    counts: Mapping[int, int], capacity: int
) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Patterns fixed by dominance, longest pieces first, and the counts that are left."""
    pool, fixed = _Pool(counts), []
    for w in sorted(pool.lengths, reverse=True):
        while w in pool.count:
            pattern = _dominating(pool, w, capacity)
            if pattern is None:
                break
            times = pool.times(pattern)
            fixed.append((pattern, times))
            pool.take(pattern, times)
    return fixed, pool.count


def best_fit(counts: Mapping[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first: a piece goes where it leaves the least room. Equal pieces and
    equally filled sequences move together; the result is that of one piece at a time."""
    by_room: list[list[list]] = [[] for _ in range(capacity + 1)]

    def put(pattern: tuple[int, ...], times: int) -> None:
        if times:
            by_room[capacity - sum(pattern)].append([pattern, times])

    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left:
            room = next((r for r in range(n, capacity + 1) if by_room[r]), None)
            if room is None:
                fits = capacity // n
                put((n,) * fits, left // fits)
                if left % fits:
                    put((n,) * (left % fits), 1)
                break
            # a sequence with the least room takes all that fit before the next one does
            pattern, times = by_room[room].pop()
            fits = min(room // n, left)
            used = min(times, left // fits)
            put(pattern + (n,) * fits, used)
            if times > used:
                by_room[room].append([pattern, times - used])
            left -= used * fits
    merged: dict[tuple[int, ...], int] = {}
    for pattern, times in (g for groups in by_room for g in groups):
        merged[pattern] = merged.get(pattern, 0) + times
    return list(merged.items())


def plan(counts: Mapping[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    fixed, rest = reduced(counts, capacity)
    return fixed + best_fit(rest, capacity)


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, list[int]]:
    """For each pattern place: the run of piece numbers that it takes, and where they go."""
    taken: dict[int, int] = {}
    out: dict[str, list[int]] = {k: [] for k in ("_length", "_from", "_to", "_first", "offset")}
    first = 0
    for pattern, times in patterns:
        for n, offset in zip(pattern, accumulate(pattern, initial=0)):
            at = taken.get(n, 0)
            for k, v in zip(out, (n, at, at + times, first, offset)):
                out[k].append(v)
            taken[n] = at + times
        first += times
    return out


def packed(
    docs: DataFrame,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """All pieces with their ``sequence_id`` and ``offset``."""
    cut = durable(pieces(docs, vocabulary, key, text, capacity, with_ids), "pieces")
    counted = cut.groupBy("_task", "length").agg(F.count(F.lit(1)).alias("_n"))
    totals = counted.groupBy("length").agg(F.sum("_n")).collect()  # at most ``capacity`` rows
    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = counted.select(
        "_task", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    table = places(plan(dict(map(tuple, totals)), capacity))
    slots = inline_table(cut.sparkSession, table, **{k: pa.int64() for k in table})
    number = F.col("_before") + F.col("_place")
    rows = cut.join(durable(tasks, "before"), ["_task", "length"]).withColumn("_number", number)
    inside = (F.col("_number") >= F.col("_from")) & (F.col("_number") < F.col("_to"))
    rows = rows.join(slots, (F.col("length") == F.col("_length")) & inside)
    return rows.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("_first") + F.col("_number") - F.col("_from")).alias("sequence_id"),
        "offset",
        *(["ids"] if with_ids else []),
    )


def sequences(rows: DataFrame) -> DataFrame:
    """The packed sequences themselves, from ``packed(..., with_ids=True)``: ids as 32-bit
    integers, gapless, and the documents in them."""
    order = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return rows.groupBy("sequence_id").agg(order.alias("_p")).select(
        "sequence_id",
        F.aggregate("_p", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.transform("_p", lambda p: F.struct(p["doc_id"], p["piece"], p["offset"])).alias("pieces"),
    )

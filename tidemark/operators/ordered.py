"""Numbering and rank statistics over a total order, without a single-task sort.

A global ``row_number`` puts every row in one task. Here the rows are range-partitioned
and sorted, each row takes its place within its slice, and the slice offsets (one number
per slice) are added.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.joins import skewed_join
from tidemark.session import durable, inline_table

# monotonically_increasing_id keeps the partition in the upper bits and the row's place
# within the partition in the lower 33
_PLACE_BITS = 33

FEW = 4096  # rows that one aggregate holds to find a rank


def number_rows(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "seq",
    start: int = 1,
    unique: bool = True,
) -> tuple[DataFrame, int]:
    """Number the rows ``start, start+1, ...`` in ``order``; also return the row count.

    With ``unique=False`` the order may have ties; they are numbered in any order, and a
    tie-break keeps a value held by many rows from filling one slice.
    """
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    if not unique:
        df = df.withColumn("_tie", F.monotonically_increasing_id())
        keys.append(F.col("_tie").asc())
    placed = df.orderBy(*keys).withColumn("_place", F.monotonically_increasing_id())
    placed = durable(placed.drop("_tie"), "numbered")

    # one row per sort partition
    sizes = sorted(placed.groupBy(_slice().alias("s")).count().collect())
    total = sum(n for _, n in sizes)
    if len(sizes) <= 1:
        return placed.withColumn(name, _within() + F.lit(start)).drop("_place"), total
    numbered = placed.withColumn("_slice", _slice()).join(_offsets(df, sizes, start), "_slice")
    return numbered.withColumn(name, _within() + F.col("_offset")).drop(
        "_place", "_slice", "_offset"
    ), total


def _slice() -> Column:
    return F.shiftright("_place", _PLACE_BITS)


def _within() -> Column:
    return F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))


def _offsets(df: DataFrame, sizes: Sequence[tuple[int, int]], start: int) -> DataFrame:
    """What comes before each slice: the running total of the slices' sizes."""
    before = list(accumulate((n for _, n in sizes), initial=start))[: len(sizes)]
    return inline_table(
        df.sparkSession,
        {"_slice": [s for s, _ in sizes], "_offset": before},
        _slice=pa.int64(),
        _offset=pa.int64(),
    )


def dense_sequence(
    df: DataFrame, order: Sequence[str | Column], name: str = "seq", start: int = 1
) -> DataFrame:
    """Dense numbers over a unique order."""
    return number_rows(df, order, name, start)[0]


def tile_of(rank: Column, total: int, tiles: int) -> Column:
    """The ``ntile(tiles)`` bucket of a 1-based rank among ``total`` rows."""
    size, extra = divmod(total, tiles)
    head = extra * (size + 1)
    big = F.ceil(rank / F.lit(size + 1))
    if size == 0:
        return big.cast("long")
    small = F.lit(extra) + F.ceil((rank - F.lit(head)) / F.lit(size))
    return F.when(rank <= head, big).otherwise(small).cast("long")


def tile_ends(
    df: DataFrame, orders: Mapping[str, Sequence[str]], tiles: int, few: int = FEW
) -> dict[str, list[Row]]:
    """For each named order, the last row (its order columns) of every tile but the last one.

    Nothing is sorted or shuffled. Each end is a rank to be found between two bounds that close
    in on it. A round samples some ``few`` rows between the bounds, reads two of them off that
    lie a little below and above the rank, and counts the rows below each; about one in 16 rows
    is left. When no more than ``few`` are, they are ordered as a whole. A task sends counts and
    some ``few`` rows for each end, however many rows there are.

    ``df`` is read twice in each round: hand in a written table. Rows that are equal in an order
    have one rank or another of theirs, and any number of them may be equal.
    """
    total = df.count()
    size, extra = divmod(total, tiles)
    ends = {
        name: [_End(df, list(columns), j * size + min(j, extra), total) for j in range(1, tiles)]
        for name, columns in orders.items()
    }
    every = [e for group in ends.values() for e in group]
    if not total or not every:
        return {name: [] for name in orders}
    seed = 0
    while wide := [e for e in every if e.row is None and e.left > few]:
        seed += 1
        drawn = df.withColumn(_DRAW, F.rand(seed))
        picks = drawn.agg(*[e.picks(few).alias(str(i)) for i, e in enumerate(wide)]).first()
        tried = [(e, row) for e, pair in zip(wide, picks) for row in pair if row is not None]
        if tried:
            counts = df.agg(*[c for i, (e, row) in enumerate(tried) for c in e.counts(row, i)]).first()
            for i, (e, row) in enumerate(tried):
                e.close_in(row, counts[f"below{i}"], counts[f"upto{i}"])
    if left := [e for e in every if e.row is None]:
        found = df.agg(*[e.found().alias(str(i)) for i, e in enumerate(left)]).first()
        for e, row in zip(left, found):
            e.row = row
    return {name: [e.row for e in group] for name, group in ends.items()}


_DRAW = "_draw"


class _End:
    """The row of one rank. It lies between ``low`` and ``high``, both excluded; ``before`` rows
    are not above ``low``, and ``left`` are between the two."""

    def __init__(self, df: DataFrame, columns: list[str], rank: int, total: int):
        self.df, self.columns, self.rank = df, columns, rank
        self.place = F.struct(*columns)
        self.low = self.high = self.row = None
        self.before, self.left = 0, total

    def _value(self, row: Row) -> Column:
        return order_literal(self.df, self.columns, row)

    def _inside(self) -> Column:
        inside = F.lit(True)
        if self.low is not None:
            inside = inside & (self.place > self._value(self.low))
        if self.high is not None:
            inside = inside & (self.place < self._value(self.high))
        return inside

    def picks(self, few: int) -> Column:
        """A row a little below the rank and one a little above, from a sample."""
        chosen = self._inside() & (F.col(_DRAW) < few / self.left)
        # equal rows once: there may be many of them
        rows = F.sort_array(F.collect_set(F.when(chosen, self.place)))
        share = (self.rank - self.before) / self.left

        def two(rows: Column) -> Column:
            # within the sample: any row of it that is counted leaves less to look at
            apart = 2 * F.sqrt(F.size(rows)) + 1
            low = F.greatest(F.lit(0), F.floor(F.size(rows) * share - apart).cast("int"))
            high = F.least(F.size(rows) - 1, F.ceil(F.size(rows) * share + apart).cast("int"))
            return F.struct(F.get(rows, low).alias("a"), F.get(rows, high).alias("b"))

        return F.get(F.transform(F.array(rows), two), F.lit(0))

    def counts(self, row: Row, i: int) -> list[Column]:
        below, upto = self.place < self._value(row), self.place <= self._value(row)
        return [F.count_if(below).alias(f"below{i}"), F.count_if(upto).alias(f"upto{i}")]

    def close_in(self, row: Row, below: int, upto: int) -> None:
        """Keep the side of ``row`` that holds the rank."""
        end = self.before + self.left
        if below < self.rank <= upto:
            self.row = row
        elif upto < self.rank and upto > self.before:
            self.low, self.before = row, upto
        elif below >= self.rank and below < end:
            self.high, end = row, below
        self.left = end - self.before

    def found(self) -> Column:
        rows = F.sort_array(F.collect_list(F.when(self._inside(), self.place)))
        return F.get(rows, F.lit(self.rank - self.before - 1))


def order_literal(df: DataFrame, columns: Sequence[str], row: Row) -> Column:
    """A row of order columns as a literal."""
    return F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(columns, row)])


def tile_in(df: DataFrame, columns: Sequence[str], ends: Sequence[Row]) -> Column:
    """The 1-based tile of each row, from the last rows of the tiles."""
    place = F.struct(*columns)
    beyond = [(place > order_literal(df, columns, end)).cast("long") for end in ends]
    return sum(beyond, F.lit(1).cast("long"))


def grouped_median(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Exact median per group; null values and null keys do not count.

    ``percentile`` would hold all distinct values of a group in one task. Here equal values
    are counted map-side, the counts are sorted across the cluster, and the values at the
    middle places are picked, so that a hot group is spread like any other rows.
    """
    counts = (
        df.select(*keys, F.col(value).alias("_v"))
        .dropna()
        .groupBy(*keys, "_v")
        .agg(F.count("*").alias("_n"))
    )
    placed = durable(
        counts.orderBy(*keys, "_v").withColumn("_place", F.monotonically_increasing_id()), "median"
    ).withColumn("_slice", _slice())
    sizes = sorted(placed.groupBy("_slice").agg(F.sum("_n")).collect())
    upto = F.sum("_n").over(Window.partitionBy("_slice").orderBy("_place"))
    running = (
        placed.withColumn("_upto", upto)
        .join(_offsets(df, sizes, 0), "_slice")
        .select(*keys, "_v", "_n", (F.col("_upto") + F.col("_offset")).alias("_upto"))
    )
    groups = running.groupBy(*keys).agg(
        F.min(F.col("_upto") - F.col("_n")).alias("_lo"), F.sum("_n").alias("_all")
    )

    def holds(middle: Column) -> Column:
        place = F.col("_lo") + F.floor(middle)
        return ((place >= F.col("_upto") - F.col("_n")) & (place < F.col("_upto"))).cast("int")

    times = holds((F.col("_all") - 1) / 2) + holds(F.col("_all") / 2)
    middle = skewed_join(running, groups, keys, "inner").withColumn("_times", times)
    return (
        middle.filter("_times > 0")
        .groupBy(*keys)
        .agg((F.sum(F.col("_v").cast("double") * F.col("_times")) / 2).alias(name))
    )

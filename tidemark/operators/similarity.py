"""Vector search: top-k for a query, filtered search, and exact nearest neighbours."""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemark.functions import vectors
from tidemark.functions.numbers import round_even
from tidemark.operators.filters import filter_given
from tidemark.operators.ordered import number_rows
from tidemark.operators.rows import top_per_group
from tidemark.session import durable, forget, owned, release

SCORE = "similarity_score"


def search(
    df: DataFrame, key: str, score: Column, k: int | None = 5, digits: int = 4
) -> DataFrame:
    """Rows by rounded score, best first, ties by key; the ``k`` best unless ``k`` is None."""
    ranked = df.withColumn(SCORE, round_even(score, digits)).orderBy(F.desc(SCORE), key)
    return ranked if k is None else ranked.limit(k)


def search_vector(
    df: DataFrame, key: str, vector: str, query: Sequence[float], k: int = 5, digits: int = 4
) -> DataFrame:
    """The ``k`` rows most similar to a query vector; a zero vector scores 0."""
    return search(df, key, vectors.cosine_to(F.col(vector), query), k, digits)


def hybrid_search(
    df: DataFrame,
    key: str,
    score: Column | None = None,
    equals: Mapping[str, Any] | None = None,
    at_least: Mapping[str, Any] | None = None,
    at_most: Mapping[str, Any] | None = None,
    k: int = 5,
    digits: int = 4,
) -> DataFrame:
    """Filters first, then ranking by score; without a score the first rows by key."""
    kept = filter_given(df, equals, at_least, at_most)
    if score is None:
        return kept.withColumn(SCORE, F.lit(None).cast("double")).orderBy(key).limit(k)
    return search(kept, key, score, k, digits)


def nearest_neighbours(
    df: DataFrame,
    key: str,
    vector: str,
    k: int = 3,
    pivots: int | None = None,
    block: int = 1024,
    digits: int = 10,
) -> DataFrame:
    """The ``k`` most similar other rows of every row, exactly: ``(key, rank, neighbour,
    score)``. Scores are compared at ``digits`` decimals and ties go to the smaller key. A null
    vector, or one with a null component, has no neighbours and is none.

    Equal vectors (by a hash of 128 bits) are searched once, whatever their number. Vectors go to
    the cell of their nearest pivot; cells are cut into blocks of about ``block`` vectors, and
    blocks that lie together make a pack. A pack is searched in itself first, which gives each
    vector a score that its neighbours must reach. Then a task meets two packs, and each two packs
    meet once, for both sides. Of these it leaves out two blocks whose cells are too far apart
    (bounds from the angles to the pivots), and compares the others by their few components of
    most weight, with the rest as a bound; what may reach is compared in full.

    Packs hold the components that are not zero. They are written once, and a task reads two slices
    of them (input splits) and hands on ``k + 1`` rows per vector. So what is shuffled and written
    grows with the vectors, and only reading and comparing with their square. ``pivots`` defaults
    to one per block, 256 at most.
    """
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    id_type = rows.schema["id"].dataType.simpleString()
    most = k + 1

    rows = durable(_coded(rows), "vectors")
    smallest = top_per_group(rows.select("digest", "id"), ["digest"], [F.col("id")], most)
    groups = smallest.groupBy("digest").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    codes = rows.groupBy("digest").agg(*[F.first(c).alias(c) for c in ("width", "n", "at", "w")])
    groups = groups.join(codes, "digest").withColumn("gid", F.col("ids")[0])
    groups = durable(groups, "groups")
    # neither a null key nor a vector without a direction can be found
    unit = groups.filter("n > 0 AND n < double('infinity') AND gid IS NOT NULL").select("digest", "gid", "ids", "width", "at", "w")
    zero_ids = [i for r in groups.filter("n = 0").select("ids").collect() for i in r.ids]

    # a bounded number of vectors for the pivots, and three figures per cell, come to the driver
    count, code_bytes, width, least_width = unit.agg(
        F.count("*"), F.avg(F.length("at") + F.length("w")), F.max("width"), F.min("width")
    ).first()
    if width != least_width:
        raise ValueError(f"vectors of {least_width} to {width} components")
    if count:
        if pivots is None:
            pivots = min(256, max(1, count // block))
        sample = _sampled(unit, count, _SAMPLED * pivots)
        centres = _centres(_Vectors([r["at"] for r in sample], [r.w for r in sample], width).rows(), pivots)
        hits = _unit_hits(unit, centres, id_type, most, block, digits, code_bytes)
        if zero_ids:
            zeros = F.explode(F.lit(zero_ids).cast(f"array<{id_type}>"))
            hits = hits.unionByName(unit.select("gid", zeros.alias("id"), F.lit(0.0).alias("score")))
    else:
        hits = None
    if zero_ids:
        # a zero vector is equally far from everything: its neighbours are the smallest keys
        first = [r.id for r in rows.select("id").orderBy("id").limit(most).collect()]
        anything = F.explode(F.lit(first).cast(f"array<{id_type}>"))
        zero_hits = groups.filter("n = 0").select("gid", anything.alias("id"), F.lit(0.0).alias("score"))
        hits = zero_hits if hits is None else hits.unionByName(zero_hits)
    if hits is None:
        hits = unit.select("gid", F.col("gid").alias("id"), F.lit(0.0).alias("score")).limit(0)

    best = top_per_group(hits, ["gid"], [F.desc("score"), F.col("id")], most, "place")
    lists = best.groupBy("gid").agg(
        F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("near")
    )
    members = rows.select("id", "digest").join(groups.select("digest", "gid"), "digest").select("id", "gid")
    others = members.join(lists, "gid").select(
        "id", F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k).alias("near")
    )
    return others.select("id", F.posexplode("near").alias("place", "x")).select(
        F.col("id").alias(key),
        (F.col("place") + 1).alias("rank"),
        F.col("x.id").alias("neighbour"),
        F.col("x.score").alias("score"),
    )


def _coded(rows: DataFrame) -> DataFrame:
    """``(id, digest, width, n, at, w)`` of ``(id, v)`` without null vectors or components:
    the length ``n`` of a vector, where its unit vector is not zero and what it is there, and a hash
    that equal vectors share."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            lists = batch.column(1)
            whole = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False))
            lists = lists.take(pa.array(whole))
            lengths = np.diff(lists.offsets.to_numpy()).astype("int64")
            values = lists.flatten()
            owner = np.repeat(np.arange(len(lengths)), lengths)
            holes = np.bincount(owner[values.is_null().to_numpy(zero_copy_only=False)], minlength=len(lengths))
            flat = values.fill_null(0.0).to_numpy(zero_copy_only=False)
            within = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            kept = (flat != 0) & (holes[owner] == 0)
            owner, within, flat = owner[kept], within[kept].astype(_AT), flat[kept]
            counts = np.bincount(owner, minlength=len(lengths))
            n = np.sqrt(np.bincount(owner, flat * flat, minlength=len(lengths)))
            at, v, w = (_binaries(x, counts) for x in (within, flat, flat / n[owner]))
            digests = [
                hashlib.blake2b(b"%d " % size + a + x, digest_size=16).digest()
                for size, a, x in zip(lengths.tolist(), at.to_pylist(), v.to_pylist())
            ]
            columns = [
                batch.column(0).take(pa.array(whole)), pa.array(digests, pa.binary()),
                pa.array(lengths.astype("int32")), pa.array(n), at, w,
            ]
            out = pa.RecordBatch.from_arrays(columns, ["id", "digest", "width", "n", "at", "w"])
            yield out.filter(pa.array(holes == 0))

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(code, f"id {id_type}, digest binary, width int, n double, at binary, w binary")


def _sampled(unit: DataFrame, count: int, most: int) -> list[Row]:
    """Some ``most`` of the vectors, by a hash of theirs. A part sends only what lies in the share needed."""
    place = F.pmod(F.xxhash64("digest"), F.lit(1_000_000))
    ordered = unit.filter(place < math.ceil(2_000_000 * most / count)).orderBy(place, "digest").limit(most)
    return ordered.select("at", "w").collect() or unit.limit(1).select("at", "w").collect()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of which a worker can hold several copies."""
    for batch in batches:
        for i in range(0, batch.num_rows, 1024):
            yield batch.slice(i, 1024)


def _binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The values end to end, cut into one binary for each count."""
    ends = np.concatenate([[0], np.cumsum(counts) * values.itemsize]).astype("int32")
    data = pa.py_buffer(np.ascontiguousarray(values))
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), data])


def _centres(units: np.ndarray, pivots: int) -> np.ndarray:
    """``pivots`` directions of which a unit vector is near one: means of what is near them, in an
    order in which neighbours are alike."""
    centres = units[:pivots].copy()
    for _ in range(5):
        sums = np.zeros_like(centres)
        np.add.at(sums, (units @ centres.T).argmax(axis=1), units)
        lengths = np.sqrt(np.einsum("ij,ij->i", sums, sums))
        some = lengths > 0
        centres[some] = sums[some] / lengths[some, None]
    alike = centres @ centres.T
    chain, left = [0], np.ones(len(centres), dtype=bool)
    while len(chain) < len(centres):
        left[chain[-1]] = False
        chain.append(int(np.where(left, alike[chain[-1]], -np.inf).argmax()))
    return centres[chain]


def _unit_hits(
    unit: DataFrame, centres: np.ndarray, id_type: str, most: int, block: int, digits: int, code_bytes: float
) -> DataFrame:
    """``(gid, id, score)``: per vector and pack that it meets, its best candidates."""
    width = centres.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            angles = _angles(_Vectors(*(batch[c].to_pylist() for c in ("at", "w")), width).rows(), centres)
            cell = angles.argmin(axis=1)
            batch = batch.append_column("cell", pa.array(cell.astype("int32")))
            yield batch.append_column("angle", pa.array(angles[np.arange(len(cell)), cell]))

    schema = f"digest binary, gid {id_type}, ids array<{id_type}>, width int, at binary, w binary, cell int, angle double"
    placed = durable(unit.mapInArrow(assign, schema), "cells")
    stats = sorted(
        placed.groupBy("cell").agg(F.count("*"), F.min("angle"), F.max("angle")).collect()
    )
    cells = np.array([r[0] for r in stats])
    sizes = np.array([r[1] for r in stats])
    nearest, farthest = (np.array([r[i] for r in stats]) for i in (2, 3))

    # large cells are cut into blocks, small ones that lie together share a block
    first_block, parts, filled = [], [], []
    for size in sizes.tolist():
        if filled and size + filled[-1] <= block:
            first_block.append(len(filled) - 1)
            parts.append(1)
            filled[-1] += size
        else:
            first_block.append(len(filled))
            parts.append(-(-size // block))
            filled += [-(-size // parts[-1])] * parts[-1]
    # enough packs for the tasks there can be, and no larger than a worker can hold two of
    tasks = unit.sparkSession.sparkContext.defaultParallelism
    room = min(_PACK_ROWS, _PACK_BYTES // (4 * width), _PACK_BYTES // max(1, int(code_bytes)))
    packs = min(len(filled), max(math.ceil(sum(filled) / max(1, room)), math.ceil(4 * math.sqrt(tasks))))
    pack_of = (np.cumsum(filled) - np.array(filled) / 2) * packs // max(1, sum(filled))
    by_cell = {int(c): (f, p) for c, f, p in zip(cells, first_block, parts)}
    # position c holds (first block, number of blocks) of cell c
    firsts = F.lit([by_cell.get(c, (0, 1))[0] for c in range(len(centres))])
    counts = F.lit([by_cell.get(c, (0, 1))[1] for c in range(len(centres))])
    at = F.col("cell") + 1
    block_no = F.element_at(firsts, at) + F.pmod(F.xxhash64("digest"), F.element_at(counts, at)).cast("int")
    pack_no = F.element_at(vectors.literal(pack_of).cast("array<int>"), F.col("block") + 1)

    binaries = ["counts", "at", "w", "least", "own_query", "own_at", "own_score"]

    def pack(table: pa.Table) -> pa.Table:
        """One row per pack: members by block and key, their vectors end to end, and what they have
        found in their own pack."""
        table = table.sort_by([("block", "ascending"), ("gid", "ascending")])
        vectors_of = _Vectors(table["at"].to_pylist(), table["w"].to_pylist(), width)
        sizes_of = np.unique(table["block"].to_numpy(), return_counts=True)[1].tolist()
        own = _Pack(table["gid"].to_pylist(), sizes_of, vectors_of)
        own.blocks = list(own.blocks)
        best = _within(own, most, digits)
        least = best.score[:, -1]
        query, nth = np.nonzero(best.at >= 0)
        # the cells that the members of a block have to visit
        visits, block_cells = [], []
        cell_of = table["cell"].to_numpy()
        for (first, last), part in zip(own.ranges, own.blocks):
            angles = _angles(part.rows(), centres[cells])
            gap = np.maximum(0, np.maximum(nearest - angles, angles - farthest))
            visit = (np.cos(gap) >= least[first:last, None] - 1e-6).any(axis=0)
            visits.append(cells[visit].tolist())
            block_cells.append(np.unique(cell_of[first:last]).tolist())
        gid_type, ids = table.schema.field("gid").type, table["ids"].to_pylist()
        integers = pa.list_(pa.int32())
        columns = {
            "pack": pa.array([table["pack"][0].as_py()], pa.int32()),
            "cells": pa.array([sorted({c for x in block_cells for c in x})], integers),
            "reach": pa.array([sorted({c for x in visits for c in x})], integers),
            "gids": pa.array([table["gid"].to_pylist()], pa.list_(gid_type)),
            "ids": pa.array([[i for some in ids for i in some]], pa.list_(gid_type)),
            "copies": pa.array([[len(some) for some in ids]], integers),
            "sizes": pa.array([sizes_of], integers),
            "block_cells": pa.array([block_cells], pa.list_(integers)),
            "visits": pa.array([visits], pa.list_(integers)),
        }
        numbers = [
            vectors_of.counts.astype("int32"), vectors_of.at, vectors_of.w, least, query.astype("int32"),
            best.at[query, nth].astype("int32"), best.score[query, nth],
        ]
        columns.update((c, pa.array([x.tobytes()], pa.binary())) for c, x in zip(binaries, numbers))
        return pa.table(columns)

    packed_schema = (
        f"pack int, cells array<int>, reach array<int>, gids array<{id_type}>, ids array<{id_type}>, copies array<int>, "
        "sizes array<int>, block_cells array<array<int>>, visits array<array<int>>, "
        + ", ".join(f"{c} binary" for c in binaries)
    )
    members = placed.select("gid", "ids", "at", "w", "cell", block_no.alias("block")).withColumn("pack", pack_no)
    # Rows of some MB: without a limit a reader would hold a hundred of them and more at once,
    # and of compressed files the splits would be larger in memory than they are on disk.
    packed = durable(
        members.groupBy("pack").applyInArrow(pack, packed_schema), "packs",
        {"parquet.block.row.count.limit": 1, "compression": "uncompressed"},
    )
    forget(placed)
    # A task reads two slices of the written packs, so meetings send no matrices through a shuffle.
    one = packed.select([F.col(c).alias(f"a_{c}") for c in packed.columns])
    two = packed.select([F.col(c).alias(f"b_{c}") for c in packed.columns]).hint("shuffle_replicate_nl")
    # each two packs meet once, and each pack comes first about as often as second
    once = (F.col("a_pack") < F.col("b_pack")) == ((F.col("a_pack") + F.col("b_pack")) % 2 == 1)
    near = F.arrays_overlap("a_reach", "b_cells") | F.arrays_overlap("b_reach", "a_cells")
    same = F.col("a_pack") == F.col("b_pack")
    meetings = one.join(two, same | (once & near))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, number = None, None
        for batch in batches:
            for row in (_Row(batch, i) for i in range(batch.num_rows)):
                if row.value("a_pack") == row.value("b_pack"):
                    query, at = (row.numbers(f"a_own_{c}", "int32") for c in ("query", "at"))
                    yield _hit_rows(row, "a", "a", query, at, row.numbers("a_own_score", "float64"))
                    continue
                if row.value("a_pack") != number:
                    # one pack is held with all components, of the other a block at a time
                    a, number = None, row.value("a_pack")
                    a = _Pack.read(row, "a", width)
                    a.blocks = list(a.blocks)
                for x, y, best in zip("ab", "ba", _between(a, _Pack.read(row, "b", width), most, digits)):
                    query, nth = np.nonzero(best.at >= 0)
                    yield _hit_rows(row, x, y, query, best.at[query, nth], best.score[query, nth])

    hits = meetings.mapInArrow(meet, f"gid {id_type}, id {id_type}, score double")
    hits = durable(hits, "hits")
    forget(packed)
    return hits


class _Row:
    """A row of a batch, of which binaries are not copied."""

    def __init__(self, batch: pa.RecordBatch, place: int):
        self.batch, self.place = batch, place

    def value(self, column: str) -> Any:
        return self.batch.column(column)[self.place].as_py()

    def items(self, column: str) -> pa.Array:
        return self.batch.column(column)[self.place].values

    def numbers(self, column: str, kind: str) -> np.ndarray:
        return np.frombuffer(self.batch.column(column)[self.place].as_buffer(), kind)


def _hit_rows(row: _Row, asking: str, met: str, query: np.ndarray, at: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    """A row for each key of the vector found: ``(gid, id, score)``."""
    copies = row.items(f"{met}_copies").to_numpy()
    starts, times = np.cumsum(copies) - copies, copies[at]
    within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    keys = row.items(f"{met}_ids").take(pa.array(np.repeat(starts[at], times) + within))
    gids = row.items(f"{asking}_gids").take(pa.array(np.repeat(query, times)))
    return pa.RecordBatch.from_arrays([gids, keys, pa.array(np.repeat(score, times))], ["gid", "id", "score"])


#: Vectors for each pivot that the pivots are found from.
_SAMPLED = 16
#: Vectors in a pack, and bytes of them, at most.
_PACK_ROWS = 16384
_PACK_BYTES = 24_000_000
#: Vectors of a block that are compared with a vector one by one.
_FEW = 64
#: The type of a component's number.
_AT = "uint32"
#: What two blocks' components that are left out may add to a score: at least so much, or this share of
#: what is missing from their mean score to a score that counts.
_REST, _REST_SHARE = 0.02, 0.15


class _Vectors:
    """Vectors as the numbers and values of their components that are not zero."""

    def __init__(self, at: Sequence[bytes], w: Sequence[bytes], width: int):
        self.width = width
        self.at, self.w = np.frombuffer(b"".join(at), _AT), np.frombuffer(b"".join(w), "float64")
        self.counts = np.array([len(x) // 8 for x in w], dtype="int64")
        self.starts = np.cumsum(self.counts) - self.counts

    @classmethod
    def of(cls, counts: np.ndarray, at: np.ndarray, w: np.ndarray, width: int) -> _Vectors:
        out = cls([], [], width)
        out.counts, out.at, out.w = counts.astype("int64"), at, w
        out.starts = np.cumsum(out.counts) - out.counts
        return out

    def rows(self, index: np.ndarray | None = None) -> np.ndarray:
        """The vectors, or those of ``index``, with all components."""
        index = np.arange(len(self.counts)) if index is None else index
        counts = self.counts[index]
        taken = np.arange(counts.sum()) + np.repeat(self.starts[index] - (np.cumsum(counts) - counts), counts)
        out = np.zeros((len(index), self.width))
        out[np.repeat(np.arange(len(index)), counts), self.at[taken]] = self.w[taken]
        return out


class _Block(_Vectors):
    """The unit vectors of a block, also in single precision by row and by component."""

    def __init__(self, vectors_: _Vectors, first: int, last: int, floor: np.ndarray):
        self.at, self.w, self.width = vectors_.at, vectors_.w, vectors_.width
        self.counts, self.starts = vectors_.counts[first:last], vectors_.starts[first:last]
        self.single = self.rows().astype("float32")
        self.turned = np.ascontiguousarray(self.single.T)
        self.weight = np.einsum("ij,ij->i", self.turned, self.turned) / len(self.counts)
        self.mean = self.turned.mean(axis=1)
        self.asks(floor)

    def asks(self, least: np.ndarray) -> None:
        """Keeps a score that nine of ten vectors ask for."""
        self.asked = float(np.quantile(least, 0.1, method="lower"))

    def cut(self, components: np.ndarray) -> np.ndarray:
        """Some components, and the length of the rest, no less than it is."""
        out = np.empty((len(components) + 1, len(self.counts)), "float32")
        np.take(self.turned, components, axis=0, out=out[:-1])
        squares = np.einsum("ij,ij->j", out[:-1], out[:-1])
        out[-1] = np.sqrt(np.maximum(0, 1 - squares) + self.width * 2.0**-23)
        return out


class _Pack:
    """The blocks of a pack; ``floor`` has the score that each vector's neighbours must reach."""

    def __init__(self, gids: Sequence[Any], sizes: Sequence[int], vectors_: _Vectors, floor: np.ndarray | None = None):
        # the place of each key, where scores are equal
        self.rank = np.argsort(np.argsort(np.asarray(gids), kind="stable"), kind="stable")
        self.floor = np.full(len(gids), -np.inf) if floor is None else floor
        ends = np.cumsum(sizes).tolist()
        self.ranges = list(zip([0, *ends], ends))
        self.blocks = (_Block(vectors_, first, last, self.floor[first:last]) for first, last in self.ranges)

    @classmethod
    def read(cls, row: _Row, side: str, width: int) -> _Pack:
        at, w = row.numbers(f"{side}_at", _AT), row.numbers(f"{side}_w", "float64")
        vectors_ = _Vectors.of(row.numbers(f"{side}_counts", "int32"), at, w, width)
        floor = row.numbers(f"{side}_least", "float64")
        out = cls(row.value(f"{side}_gids"), row.value(f"{side}_sizes"), vectors_, floor)
        out.cells, out.visits = ([set(c) for c in row.value(f"{side}_{c}")] for c in ("block_cells", "visits"))
        return out


class _Best:
    """The best that vectors have met in a pack: ``most`` places and scores for each, best first,
    equal scores by the rank of the place."""

    def __init__(self, floor: np.ndarray, rank: np.ndarray, most: int):
        self.floor, self.rank, self.most = floor, rank, most
        self.score = np.full((len(floor), most), -np.inf)
        self.at = np.full((len(floor), most), -1)

    def least(self, first: int, last: int) -> np.ndarray:
        """The scores below which nothing counts for some vectors."""
        return np.maximum(self.floor[first:last], self.score[first:last, -1])

    def take(self, query: np.ndarray, at: np.ndarray, score: np.ndarray) -> None:
        if not len(query):
            return
        asked, place = np.unique(query, return_inverse=True)
        old, nth = np.nonzero(self.at[asked] >= 0)
        place = np.concatenate([place, old])
        at = np.concatenate([at, self.at[asked[old], nth]])
        score = np.concatenate([score, self.score[asked[old], nth]])
        order = np.lexsort((self.rank[at], -score, place))
        place, at, score = place[order], at[order], score[order]
        nth = np.arange(len(place)) - np.searchsorted(place, place)
        first = nth < self.most
        place, at, score, nth = place[first], at[first], score[first], nth[first]
        self.score[asked], self.at[asked] = -np.inf, -1
        self.score[asked[place], nth] = score
        self.at[asked[place], nth] = at


def _within(pack: _Pack, most: int, digits: int) -> _Best:
    """The best that the vectors of a pack find in it, themselves among them."""
    best = _Best(pack.floor, pack.rank, most)
    for (first, last), part in zip(pack.ranges, pack.blocks):
        rough = part.single @ part.turned
        least = np.full(last - first, -np.inf)
        if len(rough) >= most:
            least = np.partition(rough, -most, axis=1)[:, -most] - 2 * _error(part.width, digits)
        query, at = np.nonzero(rough >= _reach(least, part.width, digits)[:, None])
        query, at, score = _reached(query, at, least, part, part, False, most, digits)
        best.take(first + query, first + at, score)
        part.asks(best.score[first:last, -1])
    for i, (first, last) in enumerate(pack.ranges):
        for j in range(i + 1, len(pack.ranges)):
            other, end = pack.ranges[j]
            found, back = _compare(
                pack.blocks[i], pack.blocks[j], best.least(first, last), best.least(other, end), most, digits
            )
            best.take(first + found[0], other + found[1], found[2])
            best.take(other + back[0], first + back[1], back[2])
    return best


def _between(a: _Pack, b: _Pack, most: int, digits: int) -> tuple[_Best, _Best]:
    """The best that the vectors of two packs find in the other pack."""
    of_a, of_b = _Best(a.floor, b.rank, most), _Best(b.floor, a.rank, most)
    for j, ((other, end), block_b) in enumerate(zip(b.ranges, b.blocks)):
        for i, ((first, last), block_a) in enumerate(zip(a.ranges, a.blocks)):
            if a.visits[i].isdisjoint(b.cells[j]) and b.visits[j].isdisjoint(a.cells[i]):
                continue
            found, back = _compare(block_a, block_b, of_a.least(first, last), of_b.least(other, end), most, digits)
            of_a.take(first + found[0], other + found[1], found[2])
            of_b.take(other + back[0], first + back[1], back[2])
    return of_a, of_b


def _error(width: int, digits: int) -> float:
    """The most by which a product of unit vectors in single precision, and its rounding, can be off."""
    return (width + 4) * 2.0**-23 + 10.0**-digits


def _reach(least: np.ndarray, width: int, digits: int) -> np.ndarray:
    """The score in single precision from which on a vector may reach ``least``."""
    return (least - _error(width, digits) - 2.0**-23).astype("float32")


def _components(a: _Block, b: _Block) -> np.ndarray | None:
    """Few components that tell most of the blocks' scores; None for all."""
    missing = min(a.asked, b.asked) - float(a.mean @ b.mean)
    if not np.isfinite(missing):
        return None
    enough = max(_REST, _REST_SHARE * missing) ** 2
    few = None
    for weight in (a.weight, b.weight, a.weight + b.weight):
        order = np.argsort(-weight)
        rest = [np.maximum(0, x.weight.sum() - np.cumsum(x.weight[order])) for x in (a, b)]
        size = int(np.argmax(rest[0] * rest[1] <= enough)) + 1
        if few is None or size < len(few):
            few = order[:size]
    return None if len(few) > 0.9 * a.width else few


def _compare(a: _Block, b: _Block, least_a: np.ndarray, least_b: np.ndarray, most: int, digits: int):
    """``(vector, vector of the other block, score)`` of what reaches the least scores, for the vectors of
    ``a`` and for those of ``b``. Scores are first worked out in single precision, or bounded from
    some components; those that may reach are worked out in double precision."""
    components = _components(a, b)
    if components is None:
        rough = a.single @ b.turned
    else:
        rough = a.cut(components).T @ b.cut(components)
    reach_a, reach_b = (_reach(x, a.width, digits) for x in (least_a, least_b))
    may = rough >= reach_a[:, None]
    may |= rough >= reach_b
    flat = np.flatnonzero(may)
    row, column = np.divmod(flat, rough.shape[1])
    score = rough.ravel()[flat]
    of_a, of_b = score >= reach_a[row], score >= reach_b[column]
    bound = components is not None
    return (
        _reached(row[of_a], column[of_a], least_a, a, b, bound, most, digits),
        _reached(column[of_b], row[of_b], least_b, b, a, bound, most, digits),
    )


def _reached(
    query: np.ndarray, at: np.ndarray, least: np.ndarray, a: _Block, b: _Block, bound: bool, most: int, digits: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of some pairs reach the query's least score, with their scores; of a query with very many
    pairs, its best ones. ``bound``: the pairs were found by bounds only."""
    if not len(query):
        return query, at, np.zeros(0)
    reach = _reach(least, a.width, digits)
    if bound:
        # in full, one by one or all of a query at once
        many = np.bincount(query, minlength=len(least)) > _FEW
        single, few = np.flatnonzero(many), ~many[query]
        query, at = query[few], at[few]
        near = np.empty(len(query), "float32")
        for i in range(0, len(query), _CHECKED):
            some = slice(i, i + _CHECKED)
            near[some] = np.einsum("ij,ij->i", a.single[query[some]], b.single[at[some]])
        query, at = query[near >= reach[query]], at[near >= reach[query]]
        if len(single):
            place, more = np.nonzero(a.single[single] @ b.turned >= reach[single, None])
            query, at = np.concatenate([query, single[place]]), np.concatenate([at, more])
    # where very many are alike the best are picked in key order
    many = np.bincount(query, minlength=len(least)) > _FEW
    alike, few = np.flatnonzero(many), ~many[query]
    query, at = query[few], at[few]
    asking, place = np.unique(query, return_inverse=True)
    met, other = np.unique(at, return_inverse=True)
    units, others = a.rows(asking), b.rows(met)
    score = np.empty(len(query))
    for i in range(0, len(query), _CHECKED):
        some = slice(i, i + _CHECKED)
        score[some] = np.einsum("ij,ij->i", units[place[some]], others[other[some]])
    score = np.round(score, digits)
    if len(alike):
        scores = np.round(a.rows(alike) @ b.rows().T, digits)
        columns = _best_columns(scores, most)
        query = np.concatenate([query, np.repeat(alike, columns.shape[1])])
        at = np.concatenate([at, columns.ravel()])
        score = np.concatenate([score, np.take_along_axis(scores, columns, 1).ravel()])
    enough = score >= least[query]
    return query[enough], at[enough], score[enough]


#: Pairs that are worked out at a time.
_CHECKED = 256


def nearest_approximate(
    df: DataFrame,
    key: str,
    vector: str,
    k: int = 3,
    target: float = 0.9,
    tables: int = 8,
    block: int = 256,
    seed: int = 7,
    digits: int = 10,
) -> DataFrame:
    """Approximately the ``k`` most similar other rows of every row: ``(key, rank, neighbour,
    score)``. Scores are right; a neighbour may be missed, and a lesser one stand in its place.
    ``recall`` tells how many are found; a share of ``target`` is aimed at.

    Each of the ``tables`` gives a vector a code, the signs of its products with random directions,
    and sorts the vectors by it, so similar ones come to lie together. The sorted rows are cut into
    blocks twice, the second time half a block later, and rows that share a block are compared.
    So a row meets at most ``2 * tables * block`` others, also where a third of the rows have one
    code or one vector.

    The share that is found is measured on ``_PROBES`` vectors, compared with all rows in one pass.
    While it is below the target (and 0.02 for chance), a further round adds as many tables with
    blocks of twice the length to what is found. Vectors with some structure need one round or two;
    the number grows with the rows where there is none, and blocks that hold all rows end it.

    Vectors that are null, have a null component or have no length take no part.
    """
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.withColumn("n", vectors.norm(F.col("v"))).filter("n > 0")
    unit = rows.select("id", F.transform("v", lambda x: x / F.col("n")).alias("u"))
    # keys may repeat
    unit = durable(unit.withColumn("row", F.monotonically_increasing_id()), "units")
    probes = _probe_scores(unit, k, digits)
    best, owner = None, f"nearest-{uuid.uuid4().hex}"
    while True:
        with owned(owner):
            met = _met_in_blocks(unit, k, tables, block, seed, digits)
        if best is not None:
            met = met.union(best.select("id", "neighbour", "score"))
        # tables find the same pairs; their last digit may depend on the block
        met = met.groupBy("id", "neighbour").agg(F.max("score").alias("score"))
        before = best
        best = durable(top_per_group(met, ["id"], [F.desc("score"), F.col("neighbour")], k, "rank"), "nearest")
        release(df.sparkSession, owner)
        if before is not None:
            forget(before)
        share = recall(best, probes, "id").first().recall
        if share is None or share >= min(1.0, target + 0.02):
            forget(unit)
            return best.select(F.col("id").alias(key), "rank", "neighbour", "score")
        block, seed = 2 * block, seed + 1


_PROBES = 512


def _probe_scores(unit: DataFrame, k: int, digits: int) -> DataFrame:
    """The ``k`` best scores of ``_PROBES`` vectors against all rows: (``id``, ``score``)."""
    probes = unit.orderBy(F.xxhash64("id"), "id").limit(_PROBES).toPandas()
    ids = probes["id"].tolist()
    asked = np.stack(probes["u"].to_numpy()) if ids else np.zeros((0, 1))
    id_type = unit.schema["id"].dataType.simpleString()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf) and ids:
                scores = np.round(asked @ np.stack(pdf["u"].to_numpy()).T, digits)
                # one more, as a vector meets itself
                best = _best_columns(scores, min(k + 1, len(pdf)))
                owner = np.repeat(np.arange(len(ids)), best.shape[1])
                yield pd.DataFrame(
                    {
                        "id": [ids[o] for o in owner],
                        "neighbour": pdf["id"].to_numpy()[best.ravel()],
                        "score": np.take_along_axis(scores, best, 1).ravel(),
                    }
                )

    met = unit.mapInPandas(score, f"id {id_type}, neighbour {id_type}, score double").filter("id <> neighbour")
    return durable(top_per_group(met, ["id"], [F.desc("score"), F.col("neighbour")], k).select("id", "score"), "probes")


def _met_in_blocks(unit: DataFrame, k: int, tables: int, block: int, seed: int, digits: int) -> DataFrame:
    """The ``k`` best that a row meets in each block: (``id``, ``neighbour``, ``score``)."""
    id_type = unit.schema["id"].dataType.simpleString()
    first = unit.select(F.size("u")).first()
    width = first[0] if first else 1
    directions = np.random.default_rng(seed).standard_normal((tables, width, _CODE_BITS))
    weights = 1 << np.arange(_CODE_BITS - 1, -1, -1, dtype="int64")

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                units = np.stack(pdf["u"].to_numpy())
                for t, table in enumerate(directions):
                    codes = (units @ table > 0) @ weights
                    yield pd.DataFrame({"t": np.int32(t), "code": codes, "id": pdf["id"], "row": pdf["row"]})

    # sorted without the vectors; these are sent once for each table, to many blocks at a time
    coded = unit.mapInPandas(code, f"t int, code long, id {id_type}, row long")
    placed, _ = number_rows(coded, ["t", "code", "id"], "place", 0, unique=False)
    blocks = max(1, _DEALT_ROWS // block)
    length, half = blocks * block, block // 2
    at = F.floor(F.col("place") / length)
    # the last block of the second cut ends in the next rows
    shared = (F.col("place") >= length) & (F.col("place") % length < block - half)
    ats = F.when(shared, F.array(at, at - 1)).otherwise(F.array(at))
    dealt = placed.select("t", "place", "row", F.explode(ats).alias("at")).join(unit, "row")

    def best_in_block(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        pdf = pdf.sort_values("id")
        units, ids = np.stack(pdf["u"].to_numpy()), pdf["id"].to_numpy()
        for start in range(0, len(ids), _COMPARED_ROWS):
            scores = np.round(units[start : start + _COMPARED_ROWS] @ units.T, digits)
            own = np.arange(len(scores))
            scores[own, start + own] = -np.inf
            best = _best_columns(scores, min(k, len(ids) - 1))
            yield pd.DataFrame(
                {
                    "id": np.repeat(ids[start : start + len(scores)], best.shape[1]),
                    "neighbour": ids[best.ravel()],
                    "score": np.take_along_axis(scores, best, 1).ravel(),
                }
            )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        first = int(pdf["at"].iloc[0]) * blocks
        cut = pdf["place"] // block
        shifted = (pdf["place"] + half) // block
        # what lies beyond belongs to the groups beside this one
        whole = [pdf[cut < first + blocks].groupby(cut), pdf[shifted > first].groupby(shifted)]
        met = [rows for parts in whole for _, part in parts if len(part) > 1 for rows in best_in_block(part)]
        return pd.concat(met) if met else pd.DataFrame({"id": pdf["id"][:0], "neighbour": pdf["id"][:0], "score": np.zeros(0)})

    return dealt.select("t", "at", "place", "id", "u").groupBy("t", "at").applyInPandas(
        compare, f"id {id_type}, neighbour {id_type}, score double"
    )


#: Rows that are dealt to one group at least, and those that are compared with a block at a time.
_DEALT_ROWS = 4096
_COMPARED_ROWS = 1024
_CODE_BITS = 30


def recall(found: DataFrame, exact: DataFrame, key: str) -> DataFrame:
    """One row: the neighbours ``asked`` for, those ``hit``, and ``recall``, their share. A found
    row counts as a hit if its score is as good as that of the last exact neighbour, as equal
    scores leave the choice open."""
    least = exact.groupBy(key).agg(F.min("score").alias("_least"), F.count(F.lit(1)).alias("_asked"))
    good = found.join(least, key).filter(F.col("score") >= F.col("_least") - 1e-9)
    hits = good.groupBy(key).agg(F.count(F.lit(1)).alias("_hit"))
    both = least.join(hits, key, "left").agg(
        F.coalesce(F.sum("_asked"), F.lit(0)).alias("asked"), F.coalesce(F.sum("_hit"), F.lit(0)).alias("hit")
    )
    return both.withColumn("recall", F.try_divide(F.col("hit").cast("double"), "asked"))


def _best_columns(scores: np.ndarray, most: int) -> np.ndarray:
    """The columns of the ``most`` highest scores of each row; equal scores go to the
    lower column, which holds the smaller key."""
    if most > 32:
        return np.argsort(-scores, axis=1, kind="stable")[:, :most]
    left = scores.copy()
    picks = []
    for _ in range(min(most, scores.shape[1])):
        # argmax takes the first of equal scores
        pick = left.argmax(axis=1)
        left[np.arange(len(left)), pick] = -np.inf
        picks.append(pick)
    return np.stack(picks, axis=1)


def _angles(units: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centres.T, -1.0, 1.0))


def neighbour_text(neighbours: DataFrame, key: str, name: str = "top_similar") -> DataFrame:
    """The neighbours of each row as one text, best first."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", F.col("neighbour").cast("string").alias("n"))))
    return neighbours.groupBy(key).agg(
        F.array_join(F.transform(ordered, lambda x: x["n"]), ", ").alias(name)
    )

"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers, so that sums are exact. The centred rows X are bidiagonalised: each
step multiplies the rows by one direction and the products by the rows again, X v and then the
transpose times u, in one distributed pass. Every new left and right vector is orthogonalised
against all before it. The left vectors have an entry per row and are not stored: each is X w for
a known short w, and their inner products follow from the transpose products that the passes
return anyhow. When a direction is exhausted, the next one starts from a fixed vector orthogonal
to all before. The singular values and right singular vectors of the small bidiagonal matrix give
deviations and components. Steps end once the wanted components are exact to double precision, at
the latest after as many as there are dimensions.

Scale: the rows are packed once into blocks of bounded size as Parquet; a pass reads them as
matrices, and its tasks' sums are added in a second, small stage, so the driver gets a bounded
number of short vectors. Only vectors as long as a row has entries are kept on the driver.

Defined results: rows whose vector is null or holds null, NaN, infinite entries or entries beyond
2^40 are left out, as are vectors of another length than most have (of two lengths as frequent,
the longer counts). Rows that repeat each count. Components whose eigenvalue is zero to double precision have
no whitened value and are left out; without any there are no rows. An exact deviation beyond a
long is null. Other input columns are kept, but for those named like a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ROW, quoted, unpacked
from tidemark.session import durable

FACTOR, SHIFT = 64, 1_000_000  # fixed by the contract
LARGEST = 2.0**40
BLOCK_VALUES = 1 << 18
#: Tasks that add the sums of all tasks, as they come.
SLOTS = 4
EXACT = 1e-15


@dataclass(frozen=True)
class Whitening:
    """What the fit list gives: its size and exact sums, and the components as columns."""

    count: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean, as a whole part and the rest."""
        whole = np.array([s // self.count for s in self.sums], "i8")
        rest = np.array([s % self.count / self.count for s in self.sums])
        return whole, rest

    def project(self, x: np.ndarray) -> np.ndarray:
        whole, rest = self.centre()
        return ((x - whole) - rest) @ self.components / np.sqrt(self.eigenvalues)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n x - S)^2 over the dimensions, exact, for every row."""
        n, sums = self.count, np.array(self.sums, object)
        reach = max([abs(int(v) * n - int(s)) for b in (x.min(0), x.max(0)) for v, s in zip(b, self.sums)], default=0)
        if reach * reach * max(1, len(self.sums)) < 2**62 and int(np.abs(x).max(initial=0)) * n < 2**62:
            d = x * n - sums.astype("i8")
            return (d * d).sum(1).tolist()
        d = x.astype(object) * n - sums
        return [v if v < 2**63 else None for v in (d * d).sum(1).tolist()]


def _usable(vector: str) -> tuple:
    """The rows' entries as doubles, and whether all of them can be used."""
    entries = F.col(quoted(vector)).cast("array<double>")
    good = F.forall(entries, lambda c: F.coalesce(F.abs(c) <= F.lit(LARGEST), F.lit(False)))
    return entries, entries.isNotNull() & good & (F.size(entries) > 0)


def _matrices(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    values = batch.column("_entries").flatten().to_numpy(zero_copy_only=False)
    return np.floor(values.reshape(-1, dims) * FACTOR).astype("i8") + SHIFT


def _packed(rows: DataFrame, dims: int) -> DataFrame:
    """Whole numbers in blocks of at most ``BLOCK_VALUES`` values, with their sums."""
    most = max(1, BLOCK_VALUES // dims)

    def run(batches):
        held: list[np.ndarray] = []
        for batch in batches:
            if len(batch):
                held.append(_matrices(batch, dims))
            while sum(map(len, held)) >= most:
                x = np.concatenate(held)
                yield block(x[:most])
                held = [x[most:]]
        x = np.concatenate(held) if held else np.zeros((0, dims), "i8")
        if len(x):
            yield block(x)

    def block(x: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array([len(x)], pa.int64()), pa.array([x.sum(0).tolist()], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([*columns, pa.array([x.tobytes()], pa.binary())], ["n", "sums", "block"])

    return rows.mapInArrow(run, "n long, sums array<long>, block binary")


def _summed(blocks: DataFrame, width: int, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of what ``work`` makes of one, ``width`` numbers. Tasks add their
    blocks, slots add tasks, the driver adds slots."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(width), False
        for batch in batches:
            for raw in batch.column("block"):
                total += work(np.frombuffer(raw.as_py(), "i8"))
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for raw in batch.column("part"):
                total += np.frombuffer(raw.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    parts = blocks.select("block").mapInArrow(add, "part binary")
    rows = parts.repartition(SLOTS).mapInArrow(merge, "part binary").collect()
    return np.sum([np.frombuffer(r.part) for r in rows], axis=0) if rows else np.zeros(width)


def bidiagonalise(
    dims: int, wanted: int, product: Callable[[np.ndarray], np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``wanted`` singular values and, as columns, right singular vectors of a matrix
    with ``dims`` columns, of which ``product`` gives the transpose times X times a vector.

    With left vectors u = X w and z the transpose times u, u_i and u_j have the inner product
    w_i z_j; so both sides are orthogonalised in full on short vectors."""
    start = np.random.default_rng(0)
    right, lefts, back = [], [], []  # the vectors v, w and z
    diagonal, above = [], []

    def fresh() -> np.ndarray:
        return orthogonal(start.standard_normal(dims))

    def orthogonal(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for r in right:
                v = v - (r @ v) * r
        return v

    v, beta, scale = fresh(), 0.0, 0.0
    v /= np.linalg.norm(v)
    while True:
        right.append(v)
        w = v - beta * lefts[-1] if lefts else v
        z = product(w)
        for _ in range(2):
            for w_i, z_i in zip(lefts, back):
                c = w_i @ z
                w, z = w - c * w_i, z - c * z_i
        alpha = np.sqrt(max(float(w @ z), 0.0))
        scale = max(scale, alpha, beta)
        if alpha <= scale * 1e-12:
            # the direction adds no left vector
            alpha, w, z = 0.0, np.zeros(dims), np.zeros(dims)
        else:
            w, z = w / alpha, z / alpha
        diagonal.append(alpha)
        lefts.append(w)
        back.append(z)
        k = len(right)
        small = np.diag(diagonal) + np.diag(above, 1)
        left_small, values, right_small = np.linalg.svd(small)
        if k < dims:
            rest = orthogonal(z - alpha * v)
            beta = float(np.linalg.norm(rest))
            exhausted = beta <= scale * 1e-12
            errors = beta * np.abs(left_small[-1, :wanted])
            if k >= wanted and not exhausted and errors.max() <= EXACT * values[0]:
                break
            if exhausted:
                rest, beta = fresh(), 0.0
            above.append(beta)
            v = rest / np.linalg.norm(rest)
        else:
            break
    return values[:wanted], np.array(right).T @ right_small[:wanted].T


def fit(vectors: DataFrame, components: int = 32, vector: str = "embedding") -> Whitening | None:
    """The whitening of all usable rows; None where there are none."""
    entries, good = _usable(vector)
    sizes = vectors.filter(good).groupBy(F.size(entries).alias("d")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return None
    dims = common.d
    rows = vectors.filter(good & (F.size(entries) == dims)).select(entries.alias("_entries"))
    # read once in every step
    blocks = durable(_packed(rows, dims), "blocks")
    exact = blocks.select("n", F.posexplode("sums")).groupBy("pos")
    exact = exact.agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("pos").collect()
    model = Whitening(exact[0].n, tuple(int(r.s) for r in exact), np.zeros((dims, 0)), np.zeros(0), 0.0)
    whole, rest = model.centre()

    def centred(flat: np.ndarray) -> np.ndarray:
        return (flat.reshape(-1, dims) - whole) - rest

    def product(w: np.ndarray) -> np.ndarray:
        def step(flat):
            x = centred(flat)
            return (x @ w) @ x

        return _summed(blocks, dims, step)

    trace = _summed(blocks, 1, lambda flat: np.array([np.square(centred(flat)).sum()]))[0] / model.count
    if not trace > 0:
        return Whitening(model.count, model.sums, np.zeros((dims, 0)), np.zeros(0), float(trace))
    values, vectors_ = bidiagonalise(dims, min(components, dims), product)
    some = values > values[0] * 1e-11
    eigenvalues, vectors_ = values[some] ** 2 / model.count, vectors_[:, some]
    model = Whitening(model.count, model.sums, vectors_, eigenvalues, float(trace))
    k = len(eigenvalues)

    def second(flat):
        y = model.project(flat.reshape(-1, dims))
        return np.concatenate([(y.T @ y).ravel(), y.sum(0)])

    total = _summed(blocks, k * k + k, second)
    mean = total[k * k :] / model.count
    covariance = total[: k * k].reshape(k, k) / model.count - np.outer(mean, mean)
    error = float(np.abs(covariance - np.eye(k)).max())
    return Whitening(model.count, model.sums, vectors_, eigenvalues, float(trace), error)


def whitened(
    vectors: DataFrame,
    model: Whitening | None,
    vector: str = "embedding",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The usable rows with ``deviation`` and ``whitened``, an array with an entry for every
    component. ``keep`` names the input columns wanted next to them (all if left out)."""
    entries, good = _usable(vector)
    dims = len(model.sums) if model else 0
    wanted = vectors.columns if keep is None else keep
    rows = vectors.filter(good & (F.size(entries) == dims)).select(
        F.struct(*[F.col(quoted(c)) for c in wanted]).alias(ROW), entries.alias("_entries")
    )
    schema = T.StructType(
        [
            rows.schema[ROW],
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.ArrayType(T.DoubleType())),
        ]
    )
    if model is None:
        none = rows.select(ROW, F.lit(None).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
        return unpacked(none, "deviation", "whitened")

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = _matrices(batch, dims)
            y = model.project(x)
            ends = pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(y.ravel()))
            deviations = pa.array(model.deviations(x), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(ROW), deviations, lists], schema.names)

    return unpacked(rows.mapInArrow(run, schema), "deviation", "whitened")


def component_rows(vectors: DataFrame, components: int = 32, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row for every vector and component."""
    model = fit(vectors, components, vector)
    out = whitened(vectors, model, vector, [key])
    explained = (model.eigenvalues / model.trace).tolist() if model is not None and len(model.eigenvalues) else []
    share = F.array(*map(F.lit, explained)).cast("array<double>")
    return out.select(key, "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        F.col(quoted(key)),
        (F.col("at") + 1).alias("component"),
        F.lit(model.count if model else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(share, F.col("at")).alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )

"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct n-grams of its lower-cased characters, hashed to a fixed
number of places. Each place is scaled by the log ratio of its document frequencies in toxic
and clean training texts, and a regularised logistic regression on the scaled features gives
the weights. Training sees at most ``PER_CLASS`` labelled texts of each class, taken in the
order of a hash of their key (of rows that repeat a key, the smallest text); the share of toxic
texts among all labelled rows sets the intercept. Document frequencies are counted in Spark, and
training keeps the places where they differ between the classes beyond chance: the driver receives
a count for each place and the kept places of those texts.

Scoring reads each whole text once, task by task, with a weight array of fixed size. There is
no shuffle of texts.

Defined results: a null text is an empty one; a text without n-grams gets the score of the
intercept. Without labelled texts of both classes the score is the smoothed share of toxic rows
(0.5 if there are none), the same for all. Label rows without a label are not used. Rows that
repeat each get their score. Input columns whose names equal a result column are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ROW, quoted, text_of, unpacked
from tidemark.session import durable, forget

PLACES = 1 << 18
SIZES = (3, 4, 5)
PER_CLASS = 2_000  # labelled texts of each class that training may use
SMOOTHING = 1.0
PENALTY = 1.0
LEAST_SIGNAL = 3.0  # standard errors by which document frequencies must differ


class Features:
    """Distinct n-gram places of texts."""

    def __init__(self) -> None:
        self.seen = np.zeros(PLACES, bool)

    def __call__(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4").astype("u8") + np.uint64(1)
        grams = points
        for n in range(2, max(SIZES) + 1):
            if len(points) < n:
                break
            grams = grams[:-1] * np.uint64(0x100000001B3) + points[n - 1 :]
            if n in SIZES:
                mixed = (grams ^ (grams >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
                self.seen[mixed >> np.uint64(64 - PLACES.bit_length() + 1)] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found.astype("<u4")


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of all places, ratio included
    intercept: float

    def score(self, places: np.ndarray) -> float:
        return _sigmoid(self.intercept + float(self.weights[places].sum()))


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass(frozen=True)
class Places:
    """The places that training keeps, and the log ratio of each."""

    used: np.ndarray
    ratio: np.ndarray


def choose(with_toxic: np.ndarray, with_clean: np.ndarray, toxic: int, clean: int) -> Places:
    """Places whose document frequencies differ between the classes beyond chance."""
    p, q = with_toxic / toxic, with_clean / clean
    both = (with_toxic + with_clean) / (toxic + clean)
    error = np.sqrt(both * (1 - both) * (1 / toxic + 1 / clean)) + 1e-9
    used = np.flatnonzero(np.abs(p - q) / error >= LEAST_SIGNAL)
    ratio = np.log((with_toxic + SMOOTHING) / (toxic + 2 * SMOOTHING)) - np.log(
        (with_clean + SMOOTHING) / (clean + 2 * SMOOTHING)
    )
    return Places(used, ratio[used])


def train(columns: list[np.ndarray], labels: Iterable[int], places: Places, share: float) -> Model:
    """The classifier from the labelled texts' chosen places, given by their numbers among the
    chosen ones; ``share`` of all texts are toxic."""
    y = np.array(list(labels), float)
    owner, at = np.repeat(np.arange(len(columns), dtype="i4"), list(map(len, columns))), np.concatenate(columns)
    value = places.ratio.astype("f4")[at]

    def product(w: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=value * w[at], minlength=len(y))

    def back(e: np.ndarray) -> np.ndarray:
        return np.bincount(at, weights=value * e[owner], minlength=len(places.used))

    # accelerated gradient steps; the step is one over the largest curvature
    v = np.ones(len(places.used))
    for _ in range(20):
        v = back(product(v))
        norm = np.linalg.norm(v)
        v /= norm
    step = 1 / (0.25 * (norm + len(y)) + PENALTY)
    w, b = np.zeros(len(places.used)), 0.0
    ahead_w, ahead_b, t = w, b, 1.0
    for _ in range(300):
        e = _sigmoid(product(ahead_w) + ahead_b) - y
        new_w = ahead_w - step * (back(e) + PENALTY * ahead_w)
        new_b = ahead_b - step * e.sum()
        new_t = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead_w = new_w + (t - 1) / new_t * (new_w - w)
        ahead_b = new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    weights = np.zeros(PLACES, "f4")
    weights[places.used] = w * places.ratio
    # the sample is balanced, the table is not
    toxic = y.sum()
    return Model(weights, b + math.log(share / (1 - share)) - math.log(toxic / (len(y) - toxic)))


def held_out(key: str = "doc_id", folds: int = 5) -> Column:
    return F.crc32(F.col(quoted(key)).cast("string").cast("binary")) % folds == 0


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Model:
    """Train on the labelled rows of ``docs``. ``labels`` holds the key and the label (1 toxic, 0 clean);
    rows that must not be learnt from are left out by the caller."""
    known = labels.select(F.col(quoted(key)).alias("_id"), F.col(quoted(label)).cast("int").alias("_y"))
    known = known.filter(F.col("_y").isin(0, 1) & F.col("_id").isNotNull()).distinct()
    rows = docs.select(F.col(quoted(key)).alias("_id"), text_of(text).alias("_text"))
    # labels of other documents take no place and do not count for the share; three readers
    known = durable(known.join(rows.select("_id"), "_id", "left_semi"), "labels")
    counts = dict(known.groupBy("_y").count().collect())
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    flat = Model(np.zeros(PLACES, "f4"), math.log(share / (1 - share)))
    if len(counts) < 2:
        return flat
    order = F.xxhash64("_id")
    chosen = [known.filter(F.col("_y") == y).orderBy(order, "_id").limit(PER_CLASS) for y in (0, 1)]
    # at most two times PER_CLASS keys; a key that rows repeat has one text
    sample = rows.join(F.broadcast(chosen[0].union(chosen[1])), "_id")
    sample = sample.groupBy("_id", "_y").agg(F.min("_text").alias("_text"))

    def features(batches):
        find = Features()
        for batch in batches:
            found = [find(x.as_py()).tobytes() for x in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_y"), pa.array(found, pa.binary())], ["_id", "_y", "places"]
            )

    schema = T.StructType(
        [sample.schema["_id"], T.StructField("_y", T.IntegerType()), T.StructField("places", T.BinaryType())]
    )
    found = durable(sample.select("_id", "_y", "_text").mapInArrow(features, schema), "features")

    def frequencies(batches):
        total = np.zeros((2, PLACES), "i8")
        for batch in batches:
            for y, places in zip(batch.column("_y").to_pylist(), batch.column("places")):
                total[y, np.frombuffer(places.as_py(), "<u4")] += 1
        at = np.flatnonzero(total.any(0))
        columns = [pa.array(at, pa.int64()), pa.array(total[1, at]), pa.array(total[0, at])]
        yield pa.RecordBatch.from_arrays(columns, ["place", "toxic", "clean"])

    # the driver gets a row for each of the PLACES, then the chosen places of the sample
    counted = found.select("_y", "places").mapInArrow(frequencies, "place long, toxic long, clean long")
    table = counted.groupBy("place").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toArrow()
    with_toxic, with_clean = np.zeros(PLACES), np.zeros(PLACES)
    at = table["place"].to_numpy()
    with_toxic[at], with_clean[at] = table["toxic"].to_numpy(), table["clean"].to_numpy()
    places = choose(with_toxic, with_clean, min(counts[1], PER_CLASS), min(counts[0], PER_CLASS))
    if not len(places.used):
        return flat
    used = docs.sparkSession.sparkContext.broadcast(places.used)

    def keep(batches):
        column = np.full(PLACES, -1, "i4")
        column[used.value] = np.arange(len(used.value))
        for batch in batches:
            kept = [column[np.frombuffer(x.as_py(), "<u4")] for x in batch.column("places")]
            kept = pa.array([c[c >= 0].tobytes() for c in kept], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_y"), kept], schema.names)

    sample = sorted(found.mapInArrow(keep, schema).collect(), key=lambda r: (r._id, r._y))
    forget(found)
    return train([np.frombuffer(r.places, "<i4") for r in sample], [r._y for r in sample], places, share)


def scored(
    docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """All rows with ``score`` (0 to 1, higher: more likely toxic) and ``predicted``. ``keep``
    names the input columns wanted next to the result (all if left out)."""
    wanted = docs.columns if keep is None else keep
    row = F.struct(*[F.col(quoted(c)) for c in wanted]).alias(ROW)
    rows = docs.select(row, text_of(text).alias("_text"))
    schema = T.StructType([rows.schema[ROW], T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))

    def run(batches):
        find, m = Features(), Model(*shared.value)
        for batch in batches:
            scores = [float(m.score(find(x.as_py()))) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], schema.names
            )

    out = rows.mapInArrow(run, schema)
    return unpacked(out.withColumn("predicted", (F.col("score") >= 0.5).cast("int")), "score", "predicted")


def clean_documents(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows that are not toxic, with their input columns only."""
    packed = docs.select(
        F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"),
        F.col(quoted(text)).alias("text"),
    )
    return scored(packed, model).filter("predicted = 0").select("row.*")

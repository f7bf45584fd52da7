"""TF-IDF vectors.

The vocabulary is a small model on the driver. With it, turning a text into a vector is a
plain column expression: no explode, no join and no shuffle.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import vectors
from tidemark.functions.vectors import let
from tidemark.session import inline_table

TOKEN = r"([\p{L}\p{N}_]{2,})"


def default_stop_words() -> list[str]:
    """Spark's own English list; pass another one where results must agree with it."""
    return StopWordsRemover.loadDefaultStopWords("english")


def tokens(col: Column, stop_words: Iterable[str] = ()) -> Column:
    """Lower-case words of two or more letters, digits or underscores."""
    found = F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(TOKEN), 1)
    stop = list(stop_words)
    return F.filter(found, lambda t: ~t.isin(stop)) if stop else found


@dataclass(frozen=True)
class Vocabulary:
    """The kept terms in alphabetical order (the vector dimensions) with their figures."""

    terms: tuple[str, ...]
    totals: tuple[int, ...]
    documents: tuple[int, ...]
    corpus: int
    stop_words: tuple[str, ...]

    @property
    def idf(self) -> list[float]:
        return [math.log((1 + self.corpus) / (1 + d)) + 1 for d in self.documents]

    def table(self, spark: SparkSession) -> DataFrame:
        return inline_table(
            spark,
            {
                "dimension": range(len(self.terms)),
                "term": self.terms,
                "total": self.totals,
                "documents": self.documents,
                "idf": self.idf,
            },
            dimension=pa.int64(), term=pa.string(), total=pa.int64(), documents=pa.int64(), idf=pa.float64(),
        )

    def sparse(self, col: Column) -> Column:
        """Unit vector of a text as ``array<struct<i, w>>``, i being the 0-based dimension."""
        if not self.terms:
            return F.array().cast("array<struct<i:int,w:double>>")
        hits = F.filter(tokens(col), lambda t: t.isin(list(self.terms)))
        # The terms by a hash of theirs, so that a look-up reads a short slice. Each literal is
        # one text that the optimizer folds; terms hold no white space.
        size = len(self.terms)
        hashes = [zlib.crc32(term.encode()) % size for term in self.terms]
        order = sorted(range(size), key=hashes.__getitem__)
        firsts = [sum(h < bucket for h in hashes) for bucket in range(size + 1)]
        terms = F.split(F.lit(" ".join(self.terms[i] for i in order)), " ")
        places, starts = (
            F.split(F.lit(" ".join(map(str, numbers))), " ").cast("array<int>") for numbers in (order, firsts)
        )
        idf = vectors.literal([self.idf[i] for i in order])

        def weigh(run: Column) -> Column:
            bucket = (F.crc32(F.encode(run["t"], "UTF-8")) % size).cast("int")

            def in_bucket(at: Column) -> Column:
                first = F.get(starts, at)
                found = F.array_position(F.slice(terms, first + 1, F.get(starts, at + 1) - first), run["t"])
                return (first + found - 1).cast("int")

            return let(
                let(bucket, in_bucket),
                lambda at: F.struct(F.get(places, at).alias("i"), (run["n"] * F.get(idf, at)).alias("w")),
            )

        return let(let(F.sort_array(hits), lambda h: F.transform(_runs(h), weigh)), _normalised)

    def dense(self, sparse: Column) -> Column:
        """The vector with all its dimensions."""
        size = len(self.terms)
        zeros = F.array_repeat(F.lit(0.0), size)

        def filled(sorted_: Column) -> Column:
            def part(x: Column, at: Column) -> Column:
                first = F.coalesce(F.get(sorted_, at - 1)["i"] + 1, F.lit(0))
                return F.concat(F.slice(zeros, 1, x["i"] - first), F.array(x["w"]))

            rest = F.lit(size) - F.coalesce(F.get(sorted_, F.size(sorted_) - 1)["i"] + 1, F.lit(0))
            return F.concat(F.flatten(F.transform(sorted_, part)), F.slice(zeros, 1, rest))

        return let(F.sort_array(sparse), filled)

    def embed(self, spark: SparkSession, text: str) -> list[float]:
        """The dense vector of one query text."""
        row = spark.range(1).select(self.dense(self.sparse(F.lit(text))).alias("v")).first()
        return list(row.v)


def _runs(words: Column) -> Column:
    """The distinct words of a sorted array and how often each is there, in one pass."""
    starts = F.array_compact(
        F.transform(words, lambda w, at: F.when(~w.eqNullSafe(F.get(words, at - 1)), at))
    )
    return let(
        starts,
        lambda s: F.transform(
            s,
            lambda at, j: F.struct(
                F.get(words, at).alias("t"), (F.coalesce(F.get(s, j + 1), F.size(words)) - at).cast("double").alias("n")
            ),
        ),
    )


def _normalised(weights: Column) -> Column:
    squares = F.aggregate(weights, F.lit(0.0), lambda acc, x: acc + x["w"] * x["w"])
    return let(
        F.sqrt(squares),
        lambda length: F.transform(
            weights, lambda x: F.struct(x["i"].alias("i"), (x["w"] / length).alias("w"))
        ),
    )


def fit_vocabulary(
    df: DataFrame, text: str, max_features: int = 384, stop_words: Iterable[str] | None = None
) -> Vocabulary:
    """The most frequent terms of a corpus, ties in alphabetical order.

    Two passes: the first sums the uses of all words map-side, the second counts the texts of the
    best ones. Only the ``max_features`` best terms reach the driver.
    """
    stop = list(default_stop_words() if stop_words is None else stop_words)
    words = df.select(F.explode(tokens(F.col(text))).alias("term"))
    totals = words.groupBy("term").agg(F.count(F.lit(1)).alias("total"))
    # few words are left here, so that stop words are left out at less cost than in the texts
    if stop:
        totals = totals.filter(~F.col("term").isin(stop))
    best = totals.orderBy(F.desc("total"), "term").limit(max_features).collect()
    best.sort(key=lambda r: r.term)
    known = F.filter(tokens(F.col(text)), lambda t: t.isin([r.term for r in best]))
    counted = df.select(F.explode(F.array_distinct(known)).alias("term")).groupBy("term").count()
    documents = {r.term: r["count"] for r in counted.collect()} if best else {}
    return Vocabulary(
        tuple(r.term for r in best),
        tuple(r.total for r in best),
        tuple(documents[r.term] for r in best),
        df.count(),
        tuple(stop),
    )


def sparse_score(sparse: Column, query: list[float]) -> Column:
    """Cosine of a unit sparse vector with a dense unit (or zero) query vector."""
    values = vectors.literal(query)
    return F.aggregate(
        sparse, F.lit(0.0), lambda acc, x: acc + x["w"] * F.element_at(values, x["i"] + 1)
    )

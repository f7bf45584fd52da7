"""Expressions on array<float> / array<double> vectors."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once. A column used inside a lambda would
    otherwise be worked out again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    squares = F.transform(a, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v))


def literal(values: Sequence[float]) -> Column:
    """A constant vector. One text literal that the optimizer folds into an array: a call
    into the JVM per component would take seconds for wide vectors."""
    if not len(values):
        return F.array().cast("array<double>")
    text = " ".join(repr(float(v)) for v in values)
    return F.split(F.lit(text), " ").cast("array<double>")


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; a zero vector is similar to nothing (0)."""
    lengths = norm(a) * norm(b)
    return F.when(lengths > 0, dot(a, b) / lengths).otherwise(F.lit(0.0))


def cosine_to(a: Column, query: Sequence[float]) -> Column:
    """Cosine similarity to a fixed vector, whose length is worked out beforehand."""
    length = math.sqrt(sum(float(q) ** 2 for q in query))
    if not length:
        return F.lit(0.0)
    own = norm(a)
    return F.when(own > 0, dot(a, literal(query)) / (own * F.lit(length))).otherwise(F.lit(0.0))


def prefix(a: Column, size: int = 16, digits: int = 4) -> Column:
    """The first ``size`` components, rounded half to even."""
    return F.transform(F.slice(a, 1, size), lambda x: F.bround(x.cast("double"), digits))

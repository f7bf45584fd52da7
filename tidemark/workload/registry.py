"""Registration of the workload."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import spread


class Tables:
    """The input tables of one folder, read on first use: ``tables.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        self.spark = spark
        self.folder = folder.rstrip("/")

        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table

    def spread(self, name: str) -> DataFrame:
        """A table for heavy work per row."""
        return spread(getattr(self, name))

    def once(self, name: str, make: Callable[[Tables], DataFrame]) -> DataFrame:
        """A derived table that several parts of a query share."""
        if name not in self._made:
            self._made[name] = make(self)
        return self._made[name]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query function that takes ``Tables``; ``sql`` is its counterpart."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def day_text(col: Column | str) -> Column:
    return F.date_format(col, "yyyy-MM-dd")

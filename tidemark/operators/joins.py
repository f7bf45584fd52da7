"""Joins that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 32
MOST_HOT = 64  # keys that may be spread; at most so many can hold 1/64 of the rows each
COUNTERS = 4096  # that a task keeps to find them


def hot_keys(df: DataFrame, key_hash: Column, share: float = 1 / MOST_HOT) -> list[int]:
    """The hashes of the keys that may hold more than ``share`` of the rows, ``MOST_HOT`` at most;
    null hashes do not count.

    A frequent-items sketch per task, merged: it keeps a fixed number of counters whatever the
    number of keys, and its counts miss rows / ``COUNTERS`` at most, so no such key is missed. A
    key that is named without being so frequent does no harm.
    """
    known = df.select(key_hash.alias("h")).filter("h IS NOT NULL")
    top = F.call_function("approx_top_k", "h", F.lit(MOST_HOT), F.lit(COUNTERS))
    found = known.agg(top.alias("top"), F.count(F.lit(1)).alias("n")).first()
    least = found.n * (share - 1 / COUNTERS)
    return sorted(item["item"] for item in found.top or [] if item["count"] >= max(2, least))


def _key_hash(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> Column:
    """The hash of the keys, null if one is null; equal for keys that the join takes as equal,
    also where their types differ."""

    def common(key: str) -> Column:
        if df.schema[key].dataType == other.schema[key].dataType:
            return F.col(key)
        return F.coalesce(F.lit(None).cast(other.schema[key].dataType), F.col(key))

    some_null = reduce(or_, [F.col(key).isNull() for key in keys])
    return F.when(~some_null, F.xxhash64(*map(common, keys)))


def skewed_join(
    big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Inner or left equi-join of ``big`` with ``small``, which has one row per key.

    AQE splits skewed joins by itself, but only where both sides come straight from a shuffle;
    a side that was just aggregated by the key does not. Use this there. A first pass over the
    keys of ``big`` finds the hot ones. Only their rows are spread over ``salts`` sub-keys, and
    only their rows in ``small`` are repeated; so ``small`` grows by ``MOST_HOT * salts`` rows at
    most, and not at all without hot keys. Null keys match nothing; a left join keeps their rows
    and spreads them too. Rows are spread by their content, which is the same when a task is run
    again; rows that are equal in every column stay together.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    keys = list(keys)
    mine, theirs = _key_hash(big, small, keys), _key_hash(small, big, keys)
    hot = hot_keys(big, mine)
    content = F.xxhash64(*big.columns)
    salt = F.when(mine.isNull(), F.pmod(content, F.lit(1 << 20)))
    copies = F.array(F.lit(0))
    if hot:
        salt = salt.when(mine.isin(hot), F.pmod(content, F.lit(salts)))
        copies = F.when(theirs.isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(copies)
    salted = big.withColumn("_salt", salt.otherwise(0).cast("int"))
    return salted.join(small.withColumn("_salt", F.explode(copies)), [*keys, "_salt"], how).drop("_salt")

"""What the operators share: whole rows carried as one column, and fixed values."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space between words, everywhere in this package (fixed by the data's contract)
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

ROW = "_row"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def carried(docs: DataFrame, **named: Column) -> DataFrame:
    """The whole input row as one struct column next to the named working columns, so that
    no input column can clash with them."""
    row = F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias(ROW)
    return docs.select(row, *[c.alias(n) for n, c in named.items()])


def unpacked(df: DataFrame, *added: str) -> DataFrame:
    """The carried input columns and ``added``; an added column replaces an input column of
    the same name."""
    names = [f.name for f in df.schema[ROW].dataType.fields]
    kept = [F.col(f"{ROW}.{quoted(n)}").alias(n) for n in names if n not in added]
    return df.select(*kept, *[F.col(quoted(a)) for a in added])


def text_of(name: str) -> Column:
    """A text column with null as empty."""
    return F.coalesce(F.col(quoted(name)).cast("string"), F.lit(""))


def kept_by_worker(key: Hashable, make: Callable):
    """A value that a Python worker keeps from task to task, such as a loaded vocabulary.
    (Functions travel by value, so their module's globals do not outlive a task.)"""
    store = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]

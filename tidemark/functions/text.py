"""Text hygiene and formatting."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_WORDS = ("nan", "None", "")


def strip(col: Column) -> Column:
    """Remove all leading and trailing white space (``trim`` removes spaces only)."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def clean_text(col: Column, null_words: Iterable[str] = NULL_WORDS) -> Column:
    """Strip, then turn the null words into real nulls."""
    bare = strip(col)
    return F.when(~bare.isin(list(null_words)), bare)


def clean_text_columns(
    df: DataFrame, columns: Iterable[str], null_words: Iterable[str] = NULL_WORDS
) -> DataFrame:
    """``clean_text`` over the named columns; names the table lacks are skipped."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: clean_text(F.col(c), null_words) for c in present})


def trimmed(col: Column, default: str | None = None) -> Column:
    """Trim spaces; a null becomes ``default`` when one is given."""
    bare = F.trim(col)
    return bare if default is None else F.coalesce(bare, F.lit(default))


def word_count(col: Column) -> Column:
    """Number of white-space separated words; null and blank text count 0."""
    words = F.split(strip(F.coalesce(col, F.lit(""))), r"\s+")
    return F.size(F.filter(words, lambda w: w != "")).cast("long")


def joined(*cols: Column, separator: str = ": ") -> Column:
    """Concatenate with null read as empty text."""
    parts: list[Column] = []
    for i, col in enumerate(cols):
        if i:
            parts.append(F.lit(separator))
        parts.append(F.coalesce(col, F.lit("")))
    return F.concat(*parts)


def label(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` plus a zero-padded number; wider numbers keep all their digits."""
    return F.format_string(f"{prefix}%0{width}d", number)

"""Reading amounts of money from free text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import strip
from tidemark.functions.vectors import let

# Words that mean "no amount", and the symbol and code of each currency in
# the order in which they are looked for.
NO_AMOUNT = ("not disclosed", "unknown", "n/a", "none", "-", "", "nan")
CURRENCIES = (("GBP", "£"), ("EUR", "€"), ("JPY", "¥"), ("USD", "$"))
DEFAULT_CURRENCY = "USD"


def _has_amount(text: Column) -> Column:
    return ~F.lower(text).isin(list(NO_AMOUNT))


def currency_of(col: Column) -> Column:
    """Currency code named in the text, the default where none is, null without an amount."""
    text = strip(col)
    code = None
    for name, symbol in CURRENCIES:
        found = F.contains(text, F.lit(symbol)) | F.contains(F.upper(text), F.lit(name))
        code = F.when(found, F.lit(name)) if code is None else code.when(found, F.lit(name))
    return F.when(_has_amount(text), code.otherwise(F.lit(DEFAULT_CURRENCY)))


def _scale(text: Column, word: str, suffix: str) -> Column:
    """Does lower-case ``text`` carry the unit, as a word or as a suffix letter?"""
    return text.rlike(rf"{word}|[\d.]\s*{suffix}\b|{suffix}$")


def single_amount(col: Column) -> Column:
    """One amount with an optional billion / million / thousand unit, as a double."""
    text = F.lower(strip(col))
    unit = (
        F.when(_scale(text, "billion", "b"), F.lit(1e9))
        .when(_scale(text, "million|m usd", "m"), F.lit(1e6))
        .when(_scale(text, "thousand", "k"), F.lit(1e3))
        .otherwise(F.lit(1.0))
    )
    digits = F.regexp_replace(F.regexp_extract(text, r"[\d,]+(\.\d+)?", 0), ",", "")
    return F.when(_has_amount(text), digits.try_cast("double") * unit)


def amount_of(col: Column) -> Column:
    """An amount, or the mean of the readable ends of a range such as '$10M to $20M'."""
    text = strip(col)
    is_range = text.rlike(r" - |(?i) to ")
    ends = F.filter(
        F.transform(F.split(text, r"\s+-\s+|(?i)\s+to\s+"), single_amount),
        lambda v: v.isNotNull(),
    )
    midpoint = let(
        ends,
        lambda v: F.when(
            F.size(v) > 0, F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x) / F.size(v)
        ),
    )
    return F.when(
        _has_amount(text), F.when(is_range, midpoint).otherwise(single_amount(text))
    )


def convert(amount: Column, currency: Column, rates: Mapping[str, float]) -> Column:
    """Amount times the rate of its currency; a currency without a rate counts as 1."""
    pairs = [F.lit(x) for code, rate in rates.items() for x in (code, float(rate))]
    known = F.element_at(F.create_map(*pairs), currency) if pairs else F.lit(None).cast("double")
    return amount * F.coalesce(known, F.lit(1.0))

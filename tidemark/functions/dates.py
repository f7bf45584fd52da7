"""Parsing of mixed date text and the date parts derived from it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# (shape of the text, parser patterns tried in order). The shape is tested first, so a
# row meets only the parsers that can read it. Numeric dates are read month first; the
# day-first reading is tried only when the month is impossible.
DATE_SHAPES: tuple[tuple[str, tuple[str, ...]], ...] = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", ("yyyy-M-d",)),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", ("yyyy/M/d",)),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", ("M/d/yyyy", "d/M/yyyy")),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", ("M-d-yyyy", "d-M-yyyy")),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", ("d-MMM-yyyy",)),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{2}$", ("d-MMM-yy",)),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", ("MMM d, yyyy",)),
    (r"^[A-Za-z]{4,9} \d{1,2}, \d{4}$", ("MMMM d, yyyy",)),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", ("d MMM yyyy",)),
    (r"^\d{1,2} [A-Za-z]{4,9} \d{4}$", ("d MMMM yyyy",)),
)
ISO_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?)?$"
)


def iso_timestamp(col: Column) -> Column:
    """ISO 8601 text to a timestamp; text without an offset is UTC; anything else is null.

    The session time zone must be UTC. The pattern keeps out what Spark's cast would
    also accept, such as a bare year.
    """
    return F.when(col.rlike(ISO_PATTERN), col.try_cast("timestamp"))


def parse_date(col: Column, shapes: Sequence[tuple[str, Sequence[str]]] = DATE_SHAPES) -> Column:
    """Date text in any of ``shapes``, or ISO date and time, to a date; else null."""
    text = F.trim(col)
    branches = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]"), iso_timestamp(text).cast("date"))
    for shape, patterns in shapes:
        tries = [F.try_to_timestamp(text, F.lit(p)).cast("date") for p in patterns]
        branches = branches.when(text.rlike(shape), F.coalesce(*tries))
    return branches


def expand_two_digit_year(date: Column, pivot: int) -> Column:
    """Move dates read from two-digit years above ``2000 + pivot`` back a century."""
    return F.when(F.year(date) > 2000 + pivot, F.add_months(date, -1200)).otherwise(date)


def date_parts(date: Column, prefix: str, clean_name: str) -> dict[str, Column]:
    """Day text, year, quarter, month and year-month of a date column."""
    return {
        clean_name: F.date_format(date, "dd-MM-yyyy"),
        f"{prefix}_year": F.year(date).cast("long"),
        f"{prefix}_quarter": F.quarter(date).cast("long"),
        f"{prefix}_month": F.month(date).cast("long"),
        f"{prefix}_year_month": F.date_format(date, "yyyy-MM"),
    }


def date_parts_or(date: Column, raw: Column, prefix: str, fallback: dt.date) -> dict[str, Column]:
    """Date parts for change events: an unreadable date keeps its raw text and takes
    year, quarter and month from ``fallback``."""
    quarter = (fallback.month - 1) // 3 + 1
    return {
        f"{prefix}_date": F.coalesce(F.date_format(date, "yyyy-MM-dd"), raw),
        f"{prefix}_year": F.coalesce(F.year(date), F.lit(fallback.year)).cast("long"),
        f"{prefix}_quarter": F.coalesce(F.quarter(date), F.lit(quarter)).cast("long"),
        f"{prefix}_month": F.coalesce(F.month(date), F.lit(fallback.month)).cast("long"),
        f"{prefix}_year_month": F.coalesce(
            F.date_format(date, "yyyy-MM"), F.lit(fallback.strftime("%Y-%m"))
        ),
    }

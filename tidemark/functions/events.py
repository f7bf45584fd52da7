"""Rules for change events whose fields are all text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.dates import iso_timestamp
from tidemark.functions.numbers import is_number

# The event fields, those that must be filled, and the operations.
REQUIRED_FIELDS = ("event_id", "event_timestamp", "op_code", "article_id", "company_name")
EVENT_FIELDS = REQUIRED_FIELDS + (
    "title", "category", "author", "published_date", "arr_usd_M", "summary", "url",
)
OPERATIONS = ("I", "U", "D")


def is_blank(col: Column) -> Column:
    return col.isNull() | ~col.rlike(r"\S")


def operation(col: Column) -> Column:
    return F.upper(col)


def failure_reason(
    columns: Sequence[str],
    required: Sequence[str] = REQUIRED_FIELDS,
    op: str = "op_code",
    amount: str = "arr_usd_M",
    timestamp: str = "event_timestamp",
    time: Column | None = None,
) -> Column:
    """The first broken rule as text; null for a valid event. A required field that the
    table lacks counts as empty; an amount is checked only when given. ``time`` is the
    parsed timestamp where there is a column of it already."""
    def value(name: str) -> Column:
        return F.col(name) if name in columns else F.lit(None).cast("string")

    # fixed values: the texts of the reasons
    rules = [
        F.when(is_blank(value(f)), F.lit(f"Missing or empty required field: `{f}`")) for f in required
    ]
    code = operation(value(op))
    rules.append(
        F.when(
            ~code.isin(list(OPERATIONS)),
            F.concat(F.lit("Invalid op_code `"), code, F.lit("` (Allowed: 'I', 'U', 'D')")),
        )
    )
    given = value(amount)
    rules.append(
        F.when(
            given.isNotNull() & (given != "") & ~is_number(given),
            F.concat(F.lit(f"Non-numeric `{amount}` value: "), given),
        )
    )
    stamp = value(timestamp)
    rules.append(
        F.when(
            (iso_timestamp(stamp) if time is None else time).isNull(),
            F.concat(F.lit("Malformed event_timestamp format: "), stamp),
        )
    )
    return F.coalesce(*rules)

"""Change data capture in set form.

Events are numbered by arrival (``order`` columns). Per key, the last U or D is its reset.
An event is kept when it is no D and not before the reset; a stored row survives when its
key has no reset. That gives the same tables as applying the events one by one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import date_parts_or, iso_timestamp, parse_date
from tidemark.functions.events import failure_reason, operation
from tidemark.functions.numbers import to_double
from tidemark.functions.text import label, strip, word_count
from tidemark.operators.joins import skewed_join
from tidemark.operators.mapping import look_up
from tidemark.operators.ordered import dense_sequence
from tidemark.operators.rows import last_per_key
from tidemark.operators.star import latest_view

VALID, LATE, DEAD = "valid", "late", "dead"
COUNTERS = (
    "total_records_ingested",
    "valid_records",
    "dlq_quarantined",
    "watermark_dropped_late",
    "cdc_inserted",
    "cdc_updated",
    "cdc_deleted",
)


def wall_clock_cutoff(hours: float) -> Column:
    """Now minus ``hours``; Spark fixes 'now' per query and per micro-batch."""
    return F.current_timestamp() - F.make_dt_interval(secs=F.lit(hours * 3600.0))


def event_time_cutoff(events: DataFrame, hours: float, timestamp: str = "event_timestamp") -> Column:
    """The latest event time of the valid events minus ``hours`` (one value, fetched here).
    Events may be classified already."""
    judged = events if {"outcome", "event_time", "failure_reason"} <= set(events.columns) else classify(events, timestamp=timestamp)
    in_time = F.when(F.col("outcome") == VALID, F.col("event_time"))
    micros = judged.agg(F.max(F.unix_micros(in_time))).first()[0]
    if micros is None:
        return F.lit(None).cast("timestamp")
    return F.timestamp_micros(F.lit(micros - int(hours * 3_600_000_000)))


def classify(
    events: DataFrame, cutoff: Column | None = None, timestamp: str = "event_timestamp"
) -> DataFrame:
    """Add ``failure_reason``, ``event_time``, ``op`` and ``outcome``.

    ``outcome`` is dead (a rule is broken), late (before the cutoff; equal is in time) or
    valid.
    """
    timed = events.withColumns(
        {"event_time": iso_timestamp(F.col(timestamp)), "op": operation(F.col("op_code"))}
    )
    judged = timed.withColumn(
        "failure_reason", failure_reason(events.columns, time=F.col("event_time"))
    )
    outcome = F.when(F.col("failure_reason").isNotNull(), F.lit(DEAD)).otherwise(F.lit(VALID))
    judged = judged.withColumn("outcome", outcome)
    return judged if cutoff is None else mark_late(judged, cutoff)


def mark_late(classified: DataFrame, cutoff: Column) -> DataFrame:
    """Valid events before the cutoff become late ones."""
    late = (F.col("outcome") == VALID) & (F.col("event_time") < cutoff)
    return classified.withColumn("outcome", F.when(late, F.lit(LATE)).otherwise(F.col("outcome")))


def valid_events(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("outcome") == VALID)


def dead_letters(classified: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Quarantine records: when, why and the raw event as JSON. Events with a ``logged_at``
    keep that time; otherwise it is the time of reading."""
    at = F.col("logged_at") if "logged_at" in classified.columns else F.current_timestamp()
    return classified.filter(F.col("failure_reason").isNotNull()).select(
        at.alias("quarantined_at"),
        "failure_reason",
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("raw_payload"),
    )


def batch_metrics(classified: DataFrame, batch: str | None = None) -> DataFrame:
    """Event counters, per batch when a batch column is named. They count events: a
    delete that matches nothing counts as well."""
    valid = F.col("outcome") == VALID
    tests = [
        F.lit(True), valid, F.col("outcome") == DEAD, F.col("outcome") == LATE, *[valid & (F.col("op") == op) for op in "IUD"]
    ]
    counters = [F.count(F.when(test, 1)).alias(name) for name, test in zip(COUNTERS, tests)]
    return classified.groupBy(*([batch] if batch else [])).agg(*counters)


def infer_members(
    dim: DataFrame,
    events: DataFrame,
    order: Sequence[str],
    name: str = "company_name",
    key: str = "company_id",
    prefix: str = "COMP",
    width: int = 3,
    highest: int | None = None,
) -> DataFrame:
    """Members that only the events name, numbered by first sight after the ``highest`` number
    (that of the ``dim`` keys if not given), with the ``category`` of their first event."""
    category = F.col("category") if "category" in events.columns else F.lit(None).cast("string")
    first_seen = events.groupBy(name).agg(
        F.min(F.struct(*order)).alias("_first"),
        F.min_by(F.struct(category.alias("v")), F.struct(*order)).alias("_category"),
    )
    unknown = first_seen.join(dim.select(name), name, "left_anti")
    highest = highest_number(dim, key) if highest is None else highest
    numbered = dense_sequence(unknown, ["_first"], "_n", highest + 1)
    return numbered.select(
        label(prefix, F.col("_n"), width).alias(key), name, F.col("_category.v").alias("category")
    )


def highest_number(dim: DataFrame, key: str = "company_id") -> int:
    """The highest number at the end of a key."""
    digits = F.regexp_extract(F.col(key), r"(\d+)$", 1).try_cast("long")
    return dim.agg(F.max(digits)).first()[0] or 0


def apply_events(
    existing: DataFrame,
    events: DataFrame,
    key: str,
    order: Sequence[str],
    insert: str = "upsert",
) -> tuple[DataFrame, DataFrame]:
    """``(surviving rows, kept events)``; the new table is their union.

    ``insert="upsert"``: an insert replaces earlier rows of its key, so a replay changes
    nothing. ``insert="append"``: an insert adds a row and leaves earlier ones, and a
    replayed insert is there twice.
    """
    if insert == "upsert":
        kept = last_per_key(events, [key], order).filter(F.col("op") != "D")
        return existing.join(events.select(key).distinct(), key, "left_anti"), kept
    if insert != "append":
        raise ValueError(f"insert must be 'upsert' or 'append', not {insert!r}")

    place = F.struct(*order)
    # one row per key; the events of a hot key are spread for the join
    resets = (
        events.filter(F.col("op").isin("U", "D")).groupBy(key).agg(F.max(place).alias("_reset"))
    )
    kept = (
        skewed_join(events.filter(F.col("op") != "D"), resets, [key])
        .filter(F.col("_reset").isNull() | (place >= F.col("_reset")))
        .drop("_reset")
    )
    return existing.join(resets, key, "left_anti"), kept


def article_rows(kept: DataFrame, fallback: dt.date) -> DataFrame:
    """Article facts of kept events (which carry ``company_id``). A field that is absent, as
    a column or as null, takes its default; an empty text stays."""
    def text(name: str, default: str) -> Column:
        return F.coalesce(F.col(name), F.lit(default)) if name in kept.columns else F.lit(default)

    return _dated(kept, fallback).select(
        "article_id",
        F.lit(-1).cast("long").alias("original_index"),
        "company_id",
        text("title", "").alias("title"),
        text("category", "General").alias("category"),
        text("category", "General").alias("category_clean"),
        text("author", "Unknown").alias("author"),
        F.col("published_date_clean"),
        "published_year",
        "published_quarter",
        "published_month",
        "published_year_month",
        word_count(text("summary", "")).alias("word_count"),
        text("summary", "").alias("summary"),
        text("url", "").alias("url"),
    )


def observation_rows(kept: DataFrame, fallback: dt.date, amount: str = "arr_usd_M") -> DataFrame:
    """Observations of the kept events that carry an amount, cut to whole millions."""
    whole = to_double(F.col(amount)).cast("long")
    return _dated(kept, fallback).filter(whole.isNotNull()).select(
        F.concat(F.lit("OBS_"), F.col("article_id")).alias("observation_id"),
        "article_id",
        "company_id",
        F.col("published_date_clean").alias("observation_date"),
        F.col("published_year").alias("observation_year"),
        F.col("published_quarter").alias("observation_quarter"),
        F.col("published_year_month").alias("observation_year_month"),
        whole.alias(amount),
        (whole * 1_000_000).alias(amount.removesuffix("_M")),
    )


def _dated(kept: DataFrame, fallback: dt.date) -> DataFrame:
    # an event without a date is of the day it was logged, however often it is read
    today = F.date_format("logged_at" if "logged_at" in kept.columns else F.current_date(), "yyyy-MM-dd")
    raw = F.coalesce("published_date", today) if "published_date" in kept.columns else today
    parts = date_parts_or(F.col("_date"), raw, "published", fallback)
    parts["published_date_clean"] = parts.pop("published_date")
    return kept.withColumn("_date", parse_date(raw)).withColumns(parts)


def resolve_members(events: DataFrame, dim: DataFrame, name: str = "company_name", key: str = "company_id") -> DataFrame:
    return look_up(events, dim, name, [key])


def latest_after(observations: DataFrame, dim: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """The latest view over changed facts: by date, then observation; no facts count 0."""
    return latest_view(
        observations, dim, "company_id", ["observation_date", "observation_id"],
        {
            "observation_id": "latest_observation_id",
            "article_id": "latest_article_id",
            "observation_date": "latest_observation_date",
            "arr_usd_M": "latest_arr_usd_M",
        },
        attributes, count_default=0,
    )


def latest_events(events: DataFrame, order: Sequence[str], key: str = "article_id") -> DataFrame:
    """The last event of each key, deletes included."""
    return last_per_key(events.withColumn(key, strip(F.col(key))), [key], order)


def live_rows(latest: DataFrame, key: str = "article_id", amount: str = "arr_usd_M") -> DataFrame:
    """The live state that the last events describe: one row per key not deleted."""
    return latest.filter(F.col("op") != "D").select(
        key,
        "company_name",
        to_double(F.col(amount), 0.0).alias(amount),
        F.coalesce("title", F.lit("")).alias("title"),
        F.col("event_id").alias("last_event_id"),
        F.col("event_timestamp").alias("last_updated_at"),
    )


def sync(events: DataFrame, order: Sequence[str], cutoff: Column | None = None) -> DataFrame:
    """Live state rebuilt from a whole event source; I and U both upsert, D deletes."""
    return live_rows(latest_events(valid_events(classify(events, cutoff)), order))

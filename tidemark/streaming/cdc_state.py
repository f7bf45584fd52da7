"""The warehouse tables kept up to date by each micro-batch.

The log of ``cdc_stream`` holds the classified events; here every logged batch is applied to the
tables. They lie in hash buckets (``buckets``), so a batch reads and writes the buckets of the
articles and companies that it names, and the latest view is refreshed for those companies only.
Batches take effect in the order in which they were logged; within a batch, events do by ``order``.

    dim_company, by name                        inferred members are added
    fct_article, fct_arr_observation, by article
    company_observation, by company             what the latest view is made from
    view_company_latest_arr, by company
    live, by article                            the last event of each key that is not deleted

    state = CdcState(spark, root, fallback)
    state.load(base_tables)
    cdc_stream.start(stream, root, cutoff, after_batch=state.after_batch)
    state.table("view_company_latest_arr")
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cdc
from tidemark.session import durable, forget, remove_folder
from tidemark.sources.sinks import stored_fingerprint, write_snapshot
from tidemark.streaming import cdc_stream
from tidemark.streaming.buckets import BucketedTables, Version

KEYS = {
    "dim_company": "company_name",
    "fct_article": "article_id",
    "fct_arr_observation": "article_id",
    "company_observation": "company_id",
    "view_company_latest_arr": "company_id",
    "live": "article_id",
}
_PER_COMPANY = ["company_id", "observation_id", "article_id", "observation_date", "arr_usd_M"]
_ATTRIBUTES = ("company_name", "industry", "company_size_category", "is_public")
_HIGHEST = "highest member"


class CdcState:
    """``order`` must begin with the batch; ``insert`` is that of ``cdc.apply_events``."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        fallback: dt.date,
        insert: str = "upsert",
        order: Sequence[str] = cdc_stream.FILE_ORDER,
        buckets: int = 64,
    ):
        if order[0] != "batch":
            raise ValueError("batches are applied in turn, so the order must begin with the batch")
        self.spark, self.root, self.fallback, self.insert, self.order = spark, root, fallback, insert, list(order)
        self.store = BucketedTables(spark, f"{root}/state", KEYS, buckets)

    def load(self, tables: Mapping[str, DataFrame] | None = None) -> Version:
        """Store the initial tables (``dim_company``, ``fct_article``, ``fct_arr_observation``);
        those not given start empty."""
        given = {
            name: (tables or {}).get(name, self.spark.createDataFrame([], schema))
            for name, schema in cdc_stream.BASE_SCHEMAS.items()
        }
        dim, observations = given["dim_company"], given["fct_arr_observation"]
        attributes = [c for c in _ATTRIBUTES if c in dim.columns]
        given["company_observation"] = observations.select(*_PER_COMPANY)
        given["view_company_latest_arr"] = cdc.latest_after(observations, dim, attributes)
        given["live"] = self.spark.createDataFrame([], cdc_stream.LIVE_SCHEMA)
        every = range(self.store.buckets)
        notes = {_HIGHEST: str(cdc.highest_number(dim))}
        return self.store.write(-1, {name: (df, every) for name, df in given.items()}, None, notes)

    def after_batch(self, spark: SparkSession, batch: int) -> None:
        """For ``cdc_stream.start``; a batch that is replayed is left alone."""
        self.advance(batch)

    def _touched(self, table: str, *rows: tuple[DataFrame, str]) -> list[int]:
        """The buckets of the keys in the rows; at most all of them."""
        found = [df.select(self.store.bucket(table, key).alias("b")) for df, key in rows]
        union = found[0]
        for other in found[1:]:
            union = union.union(other)
        return sorted(r.b for r in union.distinct().collect())

    def advance(self, upto: int) -> Version:
        """Apply the logged batches after the last one applied."""
        now = self.store.current() or self.load()
        if upto <= now.number:
            return now
        batches = [upto] if upto == now.number + 1 else [b for b in cdc_stream.committed(self.spark, self.root, now.number) if b <= upto]
        log = cdc_stream.read_batches(self.spark, self.root, batches)
        if log is None:
            return self.store.write(upto, {}, now)

        def read(table: str, buckets: list[int]) -> DataFrame:
            return self.store.read(now, table, buckets)

        events = cdc.valid_events(log)

        # members that only the events name, and the events with their members
        known = read("dim_company", self._touched("dim_company", (events, "company_name")))
        highest = int(now.notes[_HIGHEST])
        new = durable(cdc_stream.placeholders(known, events, self.order, highest), "members")
        named = durable(cdc.resolve_members(events, known.unionByName(new)), "named")
        grown = self._touched("dim_company", (new, "company_name"))

        # facts of the articles that the events name
        buckets = self._touched("fct_article", (named, "article_id"))
        articles, observations = read("fct_article", buckets), read("fct_arr_observation", buckets)
        survivors, kept = cdc.apply_events(articles, named, "article_id", self.order, self.insert)
        facts = survivors.unionByName(cdc.article_rows(kept, self.fallback).select(*articles.columns))
        survivors, kept = cdc.apply_events(observations, named, "article_id", self.order, self.insert)
        measured = survivors.unionByName(cdc.observation_rows(kept, self.fallback).select(*observations.columns))
        measured = durable(measured, "measured")

        # companies that lost or won an observation, or are new
        keys = named.select("article_id").distinct()
        won = measured.join(keys, "article_id", "left_semi").select(*_PER_COMPANY)
        lost = observations.join(keys, "article_id", "left_semi").select("company_id")
        companies = self._touched("company_observation", (won, "company_id"), (lost, "company_id"), (new, "company_id"))
        remaining = read("company_observation", companies).join(keys, "article_id", "left_anti").select(*_PER_COMPANY)
        per_company = durable(remaining.unionByName(won), "per_company")
        shown = read("view_company_latest_arr", companies)
        attributes = [c for c in _ATTRIBUTES if c in shown.columns]
        members = shown.select("company_id", *attributes).unionByName(new.select("company_id", *attributes))
        view = cdc.latest_after(per_company, members, attributes).select(*shown.columns)

        # the live state
        last = cdc.latest_events(named, self.order)
        alive = self._touched("live", (last, "article_id"))
        live = read("live", alive).join(last.select("article_id"), "article_id", "left_anti")
        live = live.unionByName(cdc.live_rows(last))

        changes = {
            "dim_company": (read("dim_company", grown).unionByName(new), grown),
            "fct_article": (facts, buckets),
            "fct_arr_observation": (measured, buckets),
            "company_observation": (per_company, companies),
            "view_company_latest_arr": (view, companies),
            "live": (live.select(*cdc_stream.LIVE_COLUMNS), alive),
        }
        version = self.store.write(upto, changes, now, {_HIGHEST: str(highest + new.count())})
        for step in (new, named, measured, per_company):
            forget(step)
        return version

    def table(self, name: str) -> DataFrame:
        """A table as of the last batch; empty ones before the first."""
        return self.store.read(self.store.current() or self.load(), name)

    def emit_if_changed(self, target: str) -> tuple[bool, int]:
        """Write the live state to ``target`` when it differs from what is there. Where it does
        not, only the manifest and the stored fingerprint are read."""
        now = self.store.current() or self.load()
        print_ = self.store.fingerprint(now, "live")
        changed = stored_fingerprint(self.spark, target) != print_
        if changed:
            write_snapshot(self.store.read(now, "live"), target, print_)
        return changed, print_[0]

    def trim_log(self) -> int:
        """Remove the events and marks of the batches that the tables hold, but for the last,
        which may be replayed; counters and dead letters stay. Returns how many."""
        now = self.store.current()
        done = [b for b in cdc_stream.committed(self.spark, self.root) if now is not None and b < now.number]
        for batch in done:
            remove_folder(self.spark, f"{self.root}/log/batch={batch}")
            remove_folder(self.spark, f"{self.root}/commits/batch={batch}")
        return len(done)

"""Change data capture over several landings of files: the events table arrives in three parts,
as CSV of two forms or as JSON lines, and a restarted stream takes each part as a batch."""

from pyspark.sql import functions as F

from tidemark.functions.events import EVENT_FIELDS
from tidemark.operators import cdc
from tidemark.session import durable, remove_folder, scratch_path
from tidemark.sources.sinks import write_table
from tidemark.streaming import cdc_stream
from tidemark.streaming.cdc_state import CdcState
from tidemark.workload.cdc import (
    ARTICLE_COLUMNS,
    ARTICLE_SQL,
    DUCK_EVENT,
    FALLBACK,
    JUDGED_SQL,
    LATE_HOURS,
    LATEST_SQL,
    SYNC_SQL,
    base_tables,
    facts_sql,
    feed,
)
from tidemark.workload.registry import query

LANDINGS = 3
FIELDS = (*EVENT_FIELDS, "seq")
#: Within a batch the events' own numbers decide; they are text of one width.
ORDER = ("batch", "seq")


def batches_sql(upto=LANDINGS - 1, csv=False):
    """The events with the batch they land in. Each batch has its own cutoff, and the order is
    that of the batches. In CSV a null is an empty cell; every other landing has no category."""
    category = ""
    if csv:
        category = "REPLACE (CASE WHEN batch % 2 = 0 THEN coalesce(category, '') END AS category)"
    return f"""raw AS (SELECT {DUCK_EVENT}, ts, event_id % {LANDINGS} AS batch FROM events),
ev AS (SELECT * {category} FROM raw WHERE batch <= {upto}), {JUDGED_SQL},
timed AS (SELECT * REPLACE (batch * 1000000000000 + seq AS seq), CASE WHEN failure_reason IS NOT NULL THEN 'dead'
        WHEN ts < max(ts) FILTER (failure_reason IS NULL) OVER (PARTITION BY batch) - INTERVAL {int(LATE_HOURS)} HOUR
        THEN 'late' ELSE 'valid' END AS outcome FROM judged),
good AS (SELECT * FROM timed WHERE outcome = 'valid')"""


class Feed:
    """A landing folder and the stream that reads it."""

    def __init__(self, t, fmt, insert="upsert", distinct=False, state=True):
        self.t, self.fmt, self.distinct = t, fmt, distinct
        self.landing, self.root = scratch_path(t.spark, "landing"), scratch_path(t.spark, "cdc")
        self.events = feed(t).withColumn("_landing", F.col("seq") % LANDINGS)
        self.events = durable(self.events.withColumn("seq", F.lpad(F.col("seq").cast("string"), 18, "0")), "events")
        self.state = CdcState(t.spark, self.root, FALLBACK, insert, ORDER, buckets=8) if state else None
        if state:
            self.state.load(base_tables(t))

    def land(self, number, name=None):
        """Write the files of a landing: the odd ones have other columns in another order."""
        part = self.events.filter(F.col("_landing") == number).select(*FIELDS)
        folder = f"{self.landing}/{name or f'part{number}'}"
        if self.fmt == "csv" and number % 2:
            part = part.select("seq", F.lit("x").alias("unknown"), *[f for f in reversed(EVENT_FIELDS) if f != "category"])
        write_table(part, folder, self.fmt)

    def run(self):
        """Take what is there and stop, as a job that polls the folder does each time."""
        stream = cdc_stream.event_stream(self.t.spark, f"{self.landing}/*", self.fmt, FIELDS)
        if self.distinct:
            stream = cdc_stream.deduplicated(stream)
        after = self.state.after_batch if self.state else None
        cdc_stream.start(stream, self.root, cdc_stream.event_time(LATE_HOURS), after_batch=after, fields=FIELDS).awaitTermination()

    def run_all(self):
        for number in range(LANDINGS):
            self.land(number)
            self.run()
        return self

    def run_last_again(self):
        """The last batch that had events, as after a crash before the stream noted its end."""
        spark, last = self.t.spark, cdc_stream.metrics(self.t.spark, self.root).agg(F.max("batch")).first()[0]
        for part, first in (("commits", last), ("offsets", last + 1)):
            names = spark.read.format("binaryFile").load(f"{self.root}/checkpoint/{part}").select("path").collect()
            for path in (r.path for r in names):
                if int(path.rsplit("/", 1)[-1]) >= first:
                    remove_folder(spark, path)
        self.run()


@query("stream_csv", f"WITH {facts_sql('upsert', batches_sql(csv=True))} {ARTICLE_SQL}")
def stream_csv(t):
    return Feed(t, "csv").run_all().state.table("fct_article").select(*ARTICLE_COLUMNS)


@query("stream_jsonl", f"WITH {batches_sql()} {SYNC_SQL.format(events='good')}")
def stream_jsonl(t):
    return Feed(t, "json").run_all().state.table("live")


@query("stream_replay", f"WITH {facts_sql('append', batches_sql())} {ARTICLE_SQL}")
def stream_replay(t):
    """Inserts are appended, so an event that counted twice would show."""
    run = Feed(t, "json", "append", distinct=True).run_all()
    run.land(1, "part1-sent-again")
    run.run()
    run.run_last_again()
    return run.state.table("fct_article").select(*ARTICLE_COLUMNS)


@query(
    "stream_latest",
    " UNION ALL ".join(
        f"SELECT {n} AS landing, * FROM (WITH {facts_sql('upsert', batches_sql(n))} {LATEST_SQL})" for n in range(LANDINGS)
    ),
)
def stream_latest(t):
    run, views = Feed(t, "json"), []
    for number in range(LANDINGS):
        run.land(number)
        run.run()
        view = run.state.table("view_company_latest_arr")
        # the next batches replace these files
        views.append(durable(view.select(F.lit(number).alias("landing"), *view.columns), "view"))
    return views[0].union(views[1]).union(views[2])


@query(
    "stream_quarantine",
    f"""WITH {batches_sql()} SELECT batch, event_id, failure_reason, CAST(NULL AS BIGINT) AS events FROM timed WHERE outcome = 'dead'
        UNION ALL SELECT batch, outcome, NULL, count(*) FROM timed WHERE outcome <> 'dead' GROUP BY batch, outcome""",
)
def stream_quarantine(t):
    """The dead letters that each batch appended, and the counters it kept."""
    run = Feed(t, "json", state=False).run_all()
    letters = cdc_stream.dead_letters(t.spark, run.root)
    event = F.from_json("raw_payload", "event_id STRING")["event_id"]
    number = F.regexp_extract(event, r"(\d+)$", 1).cast("long")
    dead = letters.select((number % LANDINGS).alias("batch"), event.alias("event_id"), "failure_reason", F.lit(None).cast("long").alias("events"))
    counters = cdc_stream.metrics(t.spark, run.root).unpivot(
        "batch", ["valid_records", "watermark_dropped_late"], "event_id", "events"
    )
    names = F.when(F.col("event_id") == "valid_records", cdc.VALID).otherwise(cdc.LATE)
    counted = counters.filter("events > 0").select("batch", names.alias("event_id"), F.lit(None).cast("string"), "events")
    return dead.union(counted)


@query(
    "stream_emit",
    " UNION ALL ".join(
        f"""SELECT {n} AS landing, '{tick}' AS tick, {str(tick == 'new').lower()} AS changed, count(*) AS live
            FROM (WITH {batches_sql(n)} {SYNC_SQL.format(events='good')})"""
        for n in range(LANDINGS)
        for tick in ("new", "idle")
    ),
)
def stream_emit(t):
    """The live state is written where a batch changed it, and left alone at an idle tick."""
    run, target, ticks = Feed(t, "json"), scratch_path(t.spark, "live"), []
    for number in range(LANDINGS):
        run.land(number)
        for tick in ("new", "idle"):
            run.run()
            changed, _ = run.state.emit_if_changed(target)
            emitted = t.spark.read.schema(cdc_stream.LIVE_SCHEMA).parquet(target)
            ticks.append((number, tick, changed, emitted.count()))
    return t.spark.createDataFrame(ticks, "landing INT, tick STRING, changed BOOLEAN, live LONG")

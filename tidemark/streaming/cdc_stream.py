"""Change data capture as a stream of micro-batches.

Every micro-batch is classified and written once, to its own folder of an append-only log,
partitioned by outcome. Its commit mark is written last; readers take marked batches only, and
a marked batch that is replayed is left as it is, so each event counts once. The tables are read
as base plus log through the set form in ``operators.cdc``; logging a batch therefore costs its
own size and never rewrites a table. ``compact`` folds the log into a new base. Each batch also
writes its counters and its dead letters. ``cdc_state`` keeps the tables up to date batch by batch.

    <root>/log/batch=<id>/outcome=valid|late|dead
    <root>/metrics/batch=<id>
    <root>/dead_letters/batch=<id>/ingest_date=<day>
    <root>/commits/batch=<id>
    <root>/base/upto=<id>/<table>
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.dates import iso_timestamp
from tidemark.functions.events import EVENT_FIELDS, failure_reason
from tidemark.operators import cdc
from tidemark.session import durable, forget
from tidemark.sources.readers import read_fields, read_or_empty, strings
from tidemark.sources.sinks import append_dead_letters, write_if_changed, write_table

Cutoff = Callable[[DataFrame], Column] | None
FILE_ORDER = ("batch", "_file", "_block", "_row")
#: The tables of a base that was never loaded: these columns, no rows.
BASE_SCHEMAS = {
    "dim_company": "company_id STRING, company_name STRING, industry STRING, headquarters STRING, "
    "founded_year BIGINT, employee_count BIGINT, company_size_category STRING, is_public BOOLEAN, "
    "stock_ticker STRING, has_company_metadata BOOLEAN",
    "fct_article": "article_id STRING, original_index BIGINT, company_id STRING, title STRING, category STRING, "
    "category_clean STRING, author STRING, published_date_clean STRING, published_year BIGINT, "
    "published_quarter BIGINT, published_month BIGINT, published_year_month STRING, word_count BIGINT, "
    "summary STRING, url STRING",
    "fct_arr_observation": "observation_id STRING, article_id STRING, company_id STRING, observation_date STRING, "
    "observation_year BIGINT, observation_quarter BIGINT, observation_year_month STRING, arr_usd_M BIGINT, "
    "arr_usd BIGINT",
}

LIVE_COLUMNS = ("article_id", "company_name", "arr_usd_M", "title", "last_event_id", "last_updated_at")
LIVE_SCHEMA = ", ".join(f"{c} {'DOUBLE' if c == 'arr_usd_M' else 'STRING'}" for c in LIVE_COLUMNS)


def event_stream(
    spark: SparkSession,
    folder: str,
    fmt: str = "csv",
    fields: Sequence[str] = EVENT_FIELDS,
    files_per_batch: int | None = None,
    line_breaks: bool = True,
) -> DataFrame:
    """Event files that land in a folder, CSV or JSON lines, every field as text.

    Of CSV the stream carries the paths; ``start`` reads the files of a batch and binds their
    cells to the fields by the header of each, so files may have any columns in any order.
    Without ``line_breaks`` in quoted cells a large file is read by many tasks. JSON fields that
    a line does not have are null."""
    # of binary files only the path is read
    schema = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY" if fmt == "csv" else strings(fields)
    reader = spark.readStream.schema(schema).format("binaryFile" if fmt == "csv" else fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(folder)
    if fmt == "csv":
        return rows.select(F.col("path").alias("_path"), F.lit(line_breaks).alias("_line_breaks"))
    return rows.select(
        *fields, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
    )


def deduplicated(events: DataFrame, within: str = "7 days", key: str = "event_id") -> DataFrame:
    """A stream of parsed events in which a key that arrives again ``within`` a time of its first
    arrival is left out, as after a file was sent twice. Arrival is the time of the batch, so no
    event is too late. Events that break a rule are all kept: a corrected one has the same key.

    The lines of a file lose their order, so the events must carry their own."""
    timed = events.withColumn("_time", iso_timestamp(F.col("event_timestamp")))
    broken = failure_reason(events.columns, time=F.col("_time")).isNotNull()
    keyed = timed.withColumns(
        {"_key": F.when(broken, F.uuid()).otherwise(F.col(key)), "_arrived": F.current_timestamp()}
    )
    return (
        keyed.withWatermark("_arrived", within)
        .dropDuplicatesWithinWatermark(["_key"])
        .drop("_time", "_key", "_arrived")
    )


def wall_clock(hours: float = 48.0) -> Cutoff:
    return lambda batch: cdc.wall_clock_cutoff(hours)


def event_time(hours: float = 48.0) -> Cutoff:
    return lambda batch: cdc.event_time_cutoff(batch, hours)


def start(
    stream: DataFrame,
    root: str,
    cutoff: Cutoff = None,
    trigger: Mapping | None = None,
    after_batch: Callable[[SparkSession, int], None] | None = None,
    fields: Sequence[str] = EVENT_FIELDS,
) -> StreamingQuery:
    """Log the stream under ``root``. ``trigger`` defaults to what is available now;
    ``{"processingTime": "10 seconds"}`` polls. ``after_batch`` runs once a batch is
    logged, for instance to refresh a view. ``fields`` are looked for in CSV headers. Each
    event is stamped with the time of its batch, ``logged_at``."""
    def log_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not is_committed(spark, root, batch_id):
            if "_path" in batch.columns:
                files = batch.collect()  # what the file source itself keeps on the driver
                batch = read_fields(spark, [r._path for r in files], fields, all(r._line_breaks for r in files))
            elif "_file" in batch.columns:
                # the lines of a file keep their order within a task
                batch = batch.withColumn("_row", F.monotonically_increasing_id())
                batch = batch.dropna("all", subset=[c for c in batch.columns if c in EVENT_FIELDS])
            _log(batch, root, batch_id, cutoff)
        else:
            # a replayed batch must still be run, for the state that its operators keep
            batch.write.format("noop").mode("overwrite").save()
        if after_batch:
            after_batch(spark, batch_id)

    return (
        stream.writeStream.foreachBatch(log_batch)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _log(batch: DataFrame, root: str, batch_id: int, cutoff: Cutoff) -> None:
    """Write a classified batch, its counters and its dead letters, and mark it."""
    spark = batch.sparkSession
    judged = batch_judged = cdc.classify(batch)
    if cutoff:
        # read for the cutoff and for the log: files are parsed and the stream's state is kept once
        batch_judged = durable(judged, "judged")
        judged = cdc.mark_late(batch_judged, cutoff(batch_judged))
    judged = judged.withColumn("logged_at", F.current_timestamp())
    folder = f"{root}/log/batch={batch_id}"
    write_table(judged, folder, partition_by=["outcome"])
    logged = spark.read.schema(judged.schema).parquet(folder)
    write_table(cdc.batch_metrics(logged).coalesce(1), f"{root}/metrics/batch={batch_id}")
    fields = [c for c in batch.columns if c in EVENT_FIELDS]
    append_dead_letters(cdc.dead_letters(logged.filter(F.col("outcome") == cdc.DEAD), fields), f"{root}/dead_letters", batch_id)
    write_table(spark.range(1).coalesce(1), f"{root}/commits/batch={batch_id}")
    forget(batch_judged)


def is_committed(spark: SparkSession, root: str, batch: int) -> bool:
    return not read_or_empty(spark, f"{root}/commits/batch={batch}", "id LONG").isEmpty()


def committed(spark: SparkSession, root: str, after: int | None = None) -> list[int]:
    """The numbers of the batches that are logged in full, from ``after`` on."""
    marks = read_or_empty(spark, f"{root}/commits", "id LONG, batch LONG").select("batch").distinct()
    marks = marks if after is None else marks.filter(F.col("batch") > after)
    return sorted(r.batch for r in marks.collect())


def read_log(
    spark: SparkSession, root: str, after: int | None = None, upto: int | None = None
) -> DataFrame | None:
    """The logged events with their ``batch`` and ``outcome``, of the batches ``after`` one
    and ``upto`` another; None where there is no event."""
    batches = [b for b in committed(spark, root, after) if upto is None or b <= upto]
    return read_batches(spark, root, batches)


def read_batches(spark: SparkSession, root: str, batches: Sequence[int]) -> DataFrame | None:
    paths = [f"{root}/log/batch={b}" for b in batches]
    try:
        log = spark.read.option("basePath", f"{root}/log").parquet(*paths) if paths else None
    except AnalysisException as e:
        # batches without any event have no files
        if "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None
    return log if log is None else log.withColumn("batch", F.col("batch").cast("long"))


def metrics(spark: SparkSession, root: str) -> DataFrame:
    """The event counters of every batch that had events."""
    counters = ", ".join(f"{c} LONG" for c in cdc.COUNTERS)
    stored = read_or_empty(spark, f"{root}/metrics", f"{counters}, batch LONG")
    return stored.filter(f"{cdc.COUNTERS[0]} > 0").select("batch", *cdc.COUNTERS)


def dead_letters(spark: SparkSession, root: str) -> DataFrame:
    """The quarantine records of all batches."""
    schema = "quarantined_at TIMESTAMP, failure_reason STRING, raw_payload STRING, batch LONG, ingest_date DATE"
    stored = read_or_empty(spark, f"{root}/dead_letters", schema, "json")
    return stored.select("quarantined_at", "failure_reason", "raw_payload")


def live_state(spark: SparkSession, root: str, order: Sequence[str] = FILE_ORDER) -> DataFrame:
    """One row per live key. The last event of a key wins by ``order``, so batches may
    also arrive out of order when ``order`` is the events' own sequence."""
    log = read_log(spark, root)
    if log is None:
        return spark.createDataFrame([], LIVE_SCHEMA)
    return cdc.live_rows(cdc.latest_events(cdc.valid_events(log), order))


def emit_if_changed(spark: SparkSession, root: str, target: str, order: Sequence[str] = FILE_ORDER) -> tuple[bool, int]:
    """Write the live state to ``target`` when it differs from what is there."""
    return write_if_changed(live_state(spark, root, order), target)


def _last_base(spark: SparkSession, root: str) -> int | None:
    """The newest complete base; a crashed write has no success marker."""
    try:
        done = spark.read.format("binaryFile").load(f"{root}/base/upto=*/complete/part-*")
    except AnalysisException:
        return None
    paths = [r[0] for r in done.select("path").collect()]
    return max((int(p.split("upto=")[1].split("/")[0]) for p in paths), default=None)


def load_base(spark: SparkSession, root: str, tables: Mapping[str, DataFrame]) -> None:
    """Store the initial tables: ``dim_company``, ``fct_article``, ``fct_arr_observation``."""
    _write_base(spark, root, tables, -1)


def _write_base(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], upto: int) -> None:
    folder = f"{root}/base/upto={upto}"
    for name, df in tables.items():
        write_table(df, f"{folder}/{name}")
    spark.range(1).coalesce(1).write.mode("overwrite").csv(f"{folder}/complete")


def snapshot(
    spark: SparkSession,
    root: str,
    fallback: dt.date,
    insert: str = "upsert",
    order: Sequence[str] = FILE_ORDER,
    upto: int | None = None,
) -> dict[str, DataFrame]:
    """The warehouse tables as of the last logged batch, or of batch ``upto``, with the
    refreshed latest view. Without a stored base they start empty."""
    last = _last_base(spark, root)
    dim, articles, observations = (
        spark.createDataFrame([], schema)
        if last is None
        else spark.read.parquet(f"{root}/base/upto={last}/{name}")
        for name, schema in BASE_SCHEMAS.items()
    )
    log = read_log(spark, root, last, upto)
    if log is not None:
        events = cdc.valid_events(log)
        dim = dim.unionByName(placeholders(dim, events, order))
        named = cdc.resolve_members(events, dim)
        survivors, kept = cdc.apply_events(articles, named, "article_id", order, insert)
        articles = survivors.unionByName(cdc.article_rows(kept, fallback).select(*articles.columns))
        survivors, kept = cdc.apply_events(observations, named, "article_id", order, insert)
        observations = survivors.unionByName(
            cdc.observation_rows(kept, fallback).select(*observations.columns)
        )
    attributes = [c for c in ("company_name", "industry", "company_size_category", "is_public") if c in dim.columns]
    return {
        "dim_company": dim,
        "fct_article": articles,
        "fct_arr_observation": observations,
        "view_company_latest_arr": cdc.latest_after(observations, dim, attributes),
    }


def placeholders(dim: DataFrame, events: DataFrame, order: Sequence[str], highest: int | None = None) -> DataFrame:
    """Rows of the dimension's own shape for companies that only the events name, numbered
    after ``highest``, else after the dimension's own numbers."""
    industry = F.coalesce("category", F.lit("Technology")).alias("industry")
    made = cdc.infer_members(dim, events, order, highest=highest).withColumn("industry", industry)
    constants = {
        "headquarters": "Unknown",
        "company_size_category": "Unknown",
        "is_public": False,
        "has_company_metadata": False,
    }
    return made.select(
        *[
            F.col(f.name)
            if f.name in made.columns
            else F.lit(constants.get(f.name)).cast(f.dataType).alias(f.name)
            for f in dim.schema.fields
        ]
    )


def compact(
    spark: SparkSession, root: str, fallback: dt.date, insert: str = "upsert",
    order: Sequence[str] = FILE_ORDER,
) -> int | None:
    """Fold the log into a new base; returns the last batch it holds."""
    last = max(committed(spark, root), default=None)
    if last is None or last == _last_base(spark, root):
        return last
    tables = snapshot(spark, root, fallback, insert, order, last)
    tables.pop("view_company_latest_arr")
    _write_base(spark, root, tables, last)
    return last

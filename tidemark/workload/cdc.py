"""Change data capture queries: the events table read as a feed of text events."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.events import EVENT_FIELDS
from tidemark.functions.text import label
from tidemark.operators import cdc
from tidemark.session import durable, scratch_path
from tidemark.sources.readers import strings
from tidemark.streaming import cdc_stream
from tidemark.workload.registry import Tables, query

LATE_HOURS = 480.0
FALLBACK = dt.date(2026, 9, 1)
ORDER = ["seq"]

# Both dialects read this text. {iso} and {day} are the dialect's date formatting.
RAW_EVENT = """
    event_id AS seq,
    'EVT_' || event_id AS event_id,
    CASE WHEN event_id % 97 = 0 THEN 'yesterday' ELSE {iso} END AS event_timestamp,
    CASE WHEN event_id % 89 = 0 THEN 'x' WHEN event_type = 'error' THEN 'D'
         WHEN event_type = 'purchase' THEN 'u' WHEN event_type = 'view' THEN 'U'
         WHEN event_type = 'signup' THEN 'I' ELSE 'i' END AS op_code,
    CASE WHEN event_id % 101 = 0 THEN '  ' ELSE 'ART' || (user_id * 7 + event_id % 7) END AS article_id,
    CASE WHEN event_id % 103 = 0 THEN NULL ELSE 'Company ' || (user_id % 40) END AS company_name,
    event_type || ' by ' || user_id AS title,
    CASE WHEN event_id % 6 <> 0 THEN event_type END AS category,
    'Author ' || (user_id % 9) AS author,
    CASE event_id % 4 WHEN 0 THEN {day} WHEN 1 THEN 'soon' WHEN 2 THEN '' ELSE {day} END AS published_date,
    CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 107 = 0 THEN 'INVALID'
         ELSE CAST(CAST(value AS DECIMAL(18,2)) AS {text}) END AS "arr_usd_M",
    props || ' seen' AS summary,
    CASE WHEN event_id % 2 = 0 THEN 'https://example.com/' || event_id END AS url
"""
SPARK_EVENT = RAW_EVENT.replace('"arr_usd_M"', "`arr_usd_M`").format(
    iso="date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")",
    day="date_format(ts, 'yyyy-MM-dd')",
    text="STRING",
)
DUCK_EVENT = RAW_EVENT.format(
    iso="strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')", day="strftime(ts, '%Y-%m-%d')", text="VARCHAR"
)


def raw_events(df):
    fields = [f.strip() for f in split_fields(SPARK_EVENT)]
    return df.selectExpr(*fields)


def feed(t):
    return raw_events(t.spread("events"))


def split_fields(text):
    """Split a select list at its top-level commas."""
    out, depth, quote, part = [], 0, None, ""
    for ch in text:
        if quote:
            quote = None if ch == quote else quote
        elif ch in "'\"":
            quote = ch
        elif ch in "()":
            depth += 1 if ch == "(" else -1
        if ch == "," and depth == 0 and not quote:
            out.append(part)
            part = ""
        else:
            part += ch
    return [*out, part]


JUDGED_SQL = """judged AS (SELECT *, upper(op_code) AS op, CASE
        WHEN trim(article_id) = '' THEN 'Missing or empty required field: `article_id`'
        WHEN company_name IS NULL THEN 'Missing or empty required field: `company_name`'
        WHEN op_code = 'x' THEN 'Invalid op_code `X` (Allowed: ''I'', ''U'', ''D'')'
        WHEN "arr_usd_M" = 'INVALID' THEN 'Non-numeric `arr_usd_M` value: INVALID'
        WHEN event_timestamp = 'yesterday' THEN 'Malformed event_timestamp format: yesterday'
    END AS failure_reason FROM ev)"""
EVENT_SQL = f"""ev AS (SELECT {DUCK_EVENT}, ts FROM events), {JUDGED_SQL},
timed AS (SELECT *, CASE WHEN failure_reason IS NOT NULL THEN 'dead'
        WHEN ts < (SELECT max(ts) FROM judged WHERE failure_reason IS NULL) - INTERVAL {int(LATE_HOURS)} HOUR
        THEN 'late' ELSE 'valid' END AS outcome FROM judged),
good AS (SELECT * FROM timed WHERE outcome = 'valid')"""


def classified(t):
    events = feed(t)
    return cdc.classify(events, cdc.event_time_cutoff(events, LATE_HOURS))


@query("event_validate", f"WITH {EVENT_SQL} SELECT event_id, failure_reason FROM judged")
def event_validate(t):
    return cdc.classify(feed(t)).select("event_id", "failure_reason")


@query(
    "dead_letter",
    f"WITH {EVENT_SQL} SELECT event_id, op_code, url, failure_reason FROM judged WHERE failure_reason IS NOT NULL",
)
def dead_letter(t):
    letters = cdc.dead_letters(cdc.classify(feed(t)), EVENT_FIELDS)
    payload = F.from_json("raw_payload", strings(EVENT_FIELDS))
    return letters.withColumn("p", payload).select("p.event_id", "p.op_code", "p.url", "failure_reason")


@query("late_drop", f"WITH {EVENT_SQL} SELECT event_id, outcome FROM timed")
def late_drop(t):
    return classified(t).select("event_id", "outcome")


@query(
    "cdc_metrics",
    f"""WITH {EVENT_SQL} SELECT seq // 1000 AS batch, count(*) AS total_records_ingested,
            count(*) FILTER (outcome = 'valid') AS valid_records,
            count(*) FILTER (outcome = 'dead') AS dlq_quarantined,
            count(*) FILTER (outcome = 'late') AS watermark_dropped_late,
            count(*) FILTER (outcome = 'valid' AND op = 'I') AS cdc_inserted,
            count(*) FILTER (outcome = 'valid' AND op = 'U') AS cdc_updated,
            count(*) FILTER (outcome = 'valid' AND op = 'D') AS cdc_deleted
        FROM timed GROUP BY 1""",
)
def cdc_metrics(t):
    return cdc.batch_metrics(classified(t).withColumn("batch", F.floor(F.col("seq") / 1000)), "batch")


def base_tables(t):
    """Initial warehouse: companies from the nations, articles from the parts."""
    dim = t.nation.select(
        label("COMP", F.col("n_nationkey") + 1, 3).alias("company_id"),
        F.concat(F.lit("Company "), "n_nationkey").alias("company_name"),
        F.col("n_name").alias("industry"),
    )
    article = F.concat(F.lit("ART"), F.col("p_partkey"))
    company = label("COMP", F.col("p_partkey") % 25 + 1, 3)
    articles = t.part.select(
        article.alias("article_id"), F.lit(0).cast("long").alias("original_index"),
        company.alias("company_id"), F.col("p_name").alias("title"), F.col("p_brand").alias("category"),
        F.col("p_type").alias("category_clean"), F.lit("Unknown").alias("author"),
        F.lit("2021-05-01").alias("published_date_clean"), F.lit(2021).cast("long").alias("published_year"),
        F.lit(2).cast("long").alias("published_quarter"), F.lit(5).cast("long").alias("published_month"),
        F.lit("2021-05").alias("published_year_month"), F.lit(3).cast("long").alias("word_count"),
        F.col("p_name").alias("summary"), F.lit(None).cast("string").alias("url"),
    )
    metric = F.floor("p_retailprice")
    observations = t.part.select(
        F.concat(F.lit("ARR"), F.col("p_partkey")).alias("observation_id"), article.alias("article_id"),
        company.alias("company_id"), F.lit("2021-05-01").alias("observation_date"),
        F.lit(2021).cast("long").alias("observation_year"), F.lit(2).cast("long").alias("observation_quarter"),
        F.lit("2021-05").alias("observation_year_month"), metric.alias("arr_usd_M"),
        (metric * 1_000_000).alias("arr_usd"),
    )
    return {"dim_company": dim, "fct_article": articles, "fct_arr_observation": observations}


WAREHOUSE_SQL = """base_dim AS (SELECT 'COMP' || printf('%03d', n_nationkey + 1) AS company_id, 'Company ' || n_nationkey AS company_name,
                    n_name AS industry FROM nation),
firsts AS (SELECT company_name, min(seq) AS s, coalesce(first(category ORDER BY seq), 'Technology') AS industry FROM good
           WHERE company_name NOT IN (SELECT company_name FROM base_dim) GROUP BY 1),
inferred AS (SELECT 'COMP' || printf('%03d', (SELECT count(*) FROM base_dim) + row_number() OVER (ORDER BY s)) AS company_id,
                    company_name, industry FROM firsts),
dim AS (SELECT * FROM base_dim UNION ALL SELECT * FROM inferred),
base_art AS (SELECT 'ART' || p_partkey AS article_id, 'COMP' || printf('%03d', p_partkey % 25 + 1) AS company_id,
                    p_name AS title, p_brand AS category, '2021-05-01' AS d, 2021 AS y, 2 AS q, 5 AS mon, 3 AS words,
                    'ARR' || p_partkey AS observation_id, CAST(floor(p_retailprice) AS BIGINT) AS m FROM part)"""
BASE_SQL = f"{EVENT_SQL}, {WAREHOUSE_SQL}"


def facts_sql(mode, events=EVENT_SQL):
    """Surviving base rows and kept events for an insert mode."""
    if mode == "append":
        resets = "(SELECT article_id, max(seq) AS r FROM good WHERE op IN ('U', 'D') GROUP BY 1)"
        kept = f"""SELECT good.* FROM good LEFT JOIN {resets} x USING (article_id)
                   WHERE op <> 'D' AND (r IS NULL OR seq >= r)"""
        touched = "SELECT article_id FROM good WHERE op IN ('U', 'D')"
    else:
        kept = """SELECT * FROM (SELECT * FROM good QUALIFY
                  row_number() OVER (PARTITION BY article_id ORDER BY seq DESC) = 1) WHERE op <> 'D'"""
        touched = "SELECT article_id FROM good"
    return f"""{events}, {WAREHOUSE_SQL}, kept AS ({kept}),
new_art AS (SELECT article_id, company_id, title, coalesce(category, 'General') AS category,
       CASE WHEN published_date LIKE '20%' THEN published_date ELSE published_date END AS d,
       CASE WHEN published_date LIKE '20%' THEN CAST(published_date[1:4] AS INT) ELSE 2026 END AS y,
       CASE WHEN published_date LIKE '20%' THEN quarter(CAST(published_date AS DATE)) ELSE 3 END AS q,
       CASE WHEN published_date LIKE '20%' THEN CAST(published_date[6:7] AS INT) ELSE 9 END AS mon,
       3 AS words, 'OBS_' || article_id AS observation_id,
       CAST(trunc(TRY_CAST("arr_usd_M" AS DOUBLE)) AS BIGINT) AS m
   FROM kept JOIN dim USING (company_name)),
art AS (SELECT * FROM base_art WHERE article_id NOT IN ({touched}) UNION ALL SELECT * FROM new_art),
obs AS (SELECT observation_id, article_id, company_id, d, y, q, m FROM art WHERE m IS NOT NULL)"""


def applied(t, mode):
    base = base_tables(t)
    # read by the member inference, the resets and the kept events
    events = cdc.valid_events(durable(classified(t), "events"))
    dim = base["dim_company"].unionByName(cdc_stream.placeholders(base["dim_company"], events, ORDER))
    named = cdc.resolve_members(events, dim)
    survivors, kept = cdc.apply_events(base["fct_article"], named, "article_id", ORDER, mode)
    articles = survivors.unionByName(cdc.article_rows(kept, FALLBACK))
    survivors, kept = cdc.apply_events(base["fct_arr_observation"], named, "article_id", ORDER, mode)
    return dim, articles, survivors.unionByName(cdc.observation_rows(kept, FALLBACK))


ARTICLE_SQL = """SELECT article_id, company_id, title, category, d AS published_date_clean,
    y AS published_year, q AS published_quarter, mon AS published_month, words AS word_count FROM art"""
ARTICLE_COLUMNS = [
    "article_id", "company_id", "title", "category", "published_date_clean", "published_year",
    "published_quarter", "published_month", "word_count",
]


@query("cdc_apply", f"WITH {facts_sql('upsert')} {ARTICLE_SQL}")
def cdc_apply(t):
    return applied(t, "upsert")[1].select(*ARTICLE_COLUMNS)


@query("cdc_apply_append", f"WITH {facts_sql('append')} {ARTICLE_SQL}")
def cdc_apply_append(t):
    return applied(t, "append")[1].select(*ARTICLE_COLUMNS)


@query(
    "cdc_observations",
    f"""WITH {facts_sql('upsert')} SELECT observation_id, article_id, company_id, d AS observation_date,
        y AS observation_year, q AS observation_quarter, m AS "arr_usd_M", m * 1000000 AS arr_usd FROM obs""",
)
def cdc_observations(t):
    return applied(t, "upsert")[2].drop("observation_year_month")


@query("cdc_inferred_member", f"WITH {BASE_SQL} SELECT * FROM inferred")
def cdc_inferred_member(t):
    dim = base_tables(t)["dim_company"]
    return cdc_stream.placeholders(dim, cdc.valid_events(classified(t)), ORDER)


LATEST_SQL = """SELECT company_id, company_name, industry, last(observation_id ORDER BY d, observation_id) AS latest_observation_id,
        last(article_id ORDER BY d, observation_id) AS latest_article_id,
        last(d ORDER BY d, observation_id) AS latest_observation_date,
        last(m ORDER BY d, observation_id) AS "latest_arr_usd_M", count(observation_id) AS total_observations_recorded
    FROM dim LEFT JOIN obs USING (company_id) GROUP BY ALL"""


@query("cdc_latest", f"WITH {facts_sql('upsert')} {LATEST_SQL}")
def cdc_latest(t):
    dim, _, observations = applied(t, "upsert")
    return cdc.latest_after(observations, dim, ["company_name", "industry"])


SYNC_SQL = """SELECT article_id, company_name, coalesce(TRY_CAST("arr_usd_M" AS DOUBLE), 0) AS "arr_usd_M", title,
        event_id AS last_event_id, event_timestamp AS last_updated_at
    FROM (SELECT * FROM {events} QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY seq DESC) = 1)
    WHERE op <> 'D'"""


@query("cdc_sync", f"WITH {EVENT_SQL} {SYNC_SQL.format(events='good')}")
def cdc_sync(t):
    events = feed(t)
    return cdc.sync(events, ORDER, cdc.event_time_cutoff(events, LATE_HOURS))


def streamed(t: Tables, base=None):
    """Stream the events table through the log of a fresh folder; returns the folder."""
    root = scratch_path(t.spark, "cdc")
    if base:
        cdc_stream.load_base(t.spark, root, base)
    # a pattern, because the table may be one file or a folder of files
    source = t.spark.readStream.schema(t.events.schema).parquet(f"{t.folder}/events.parque[t]")
    # one cutoff for the whole table, so that the files it has make no difference
    cutoff = cdc.event_time_cutoff(feed(t), LATE_HOURS)
    cdc_stream.start(raw_events(source), root, lambda batch: cutoff).awaitTermination()
    return root


@query("cdc_stream", f"WITH {EVENT_SQL} {SYNC_SQL.format(events='good')}")
def stream_live_state(t):
    return cdc_stream.live_state(t.spark, streamed(t), ORDER)


@query("cdc_stream_latest", f"WITH {facts_sql('upsert')} {LATEST_SQL}")
def stream_latest(t):
    root = streamed(t, base_tables(t))
    cdc_stream.compact(t.spark, root, FALLBACK, order=ORDER)
    return cdc_stream.snapshot(t.spark, root, FALLBACK, order=ORDER)["view_company_latest_arr"]


@query(
    "cdc_stream_metrics",
    f"""WITH {EVENT_SQL} SELECT count(*) AS total_records_ingested, count(*) FILTER (outcome = 'valid') AS valid_records,
            count(*) FILTER (outcome = 'dead') AS dlq_quarantined,
            count(*) FILTER (outcome = 'late') AS watermark_dropped_late,
            count(*) FILTER (outcome = 'valid' AND op = 'I') AS cdc_inserted,
            count(*) FILTER (outcome = 'valid' AND op = 'U') AS cdc_updated,
            count(*) FILTER (outcome = 'valid' AND op = 'D') AS cdc_deleted
        FROM timed""",
)
def stream_metrics(t):
    counters = cdc_stream.metrics(t.spark, streamed(t)).drop("batch")
    return counters.agg(*[F.sum(c).alias(c) for c in counters.columns])

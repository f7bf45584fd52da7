"""Star schema queries: customers as members, orders as facts and observations."""

from pyspark.sql import functions as F

from tidemark.functions.dates import date_parts
from tidemark.functions.text import label
from tidemark.operators import analytics, ordered, star
from tidemark.operators.filters import semi_cohort
from tidemark.operators.mapping import look_up
from tidemark.operators.rows import first_per_key, top
from tidemark.workload.registry import day_text, query

PERIOD = ["observation_year", "observation_quarter"]


def silver(t):
    """Orders with their customer, as cleaned facts; every fourth metric is missing."""
    orders = t.orders.select(
        "o_orderkey",
        "o_custkey",
        label("ART", F.col("o_orderkey"), 4).alias("article_id"),
        F.col("o_orderpriority").alias("category_clean"),
        F.col("o_orderstatus").alias("author"),
        F.col("o_orderdate").cast("date").alias("published_date"),
        F.when(F.col("o_orderkey") % 4 != 0, F.floor(F.col("o_totalprice") / 1000)).alias("arr_usd_M"),
        (F.col("o_orderkey") % 700).alias("word_count"),
    ).withColumns(date_parts(F.col("published_date"), "published", "published_date_clean"))
    members = {"c_name": "company_name", "c_mktsegment": "industry", "c_nationkey": "nation",
               "c_acctbal": "balance"}
    return look_up(orders, t.customer, "o_custkey", members, "c_custkey")


SILVER_ORDER = ["company_name", "category_clean", "author", "published_date", "o_orderkey"]


def company_keys(t):
    return t.once("company_keys", named_keys)


def named_keys(t):
    return star.surrogate_keys(t.customer, "c_name", "company_id").withColumnRenamed(
        "c_name", "company_name"
    )


def companies(t):
    return look_up(t.customer, company_keys(t), "c_name", ["company_id"], "company_name").select(
        "company_id", F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("industry"), "c_custkey",
    )


def observations(t):
    return star.build_observations(
        silver(t),
        company_keys(t),
        "company_name",
        "company_id",
        "arr_usd_M",
        SILVER_ORDER,
        {
            "article_id": "article_id",
            "published_date": "observation_date",
            "published_year": "observation_year",
            "published_quarter": "observation_quarter",
            "published_year_month": "observation_year_month",
        },
    )


COMPANY_SQL = """company AS (
    SELECT 'COMP' || printf('%03d', row_number() OVER (ORDER BY c_name)) AS company_id,
           c_name AS company_name, c_mktsegment AS industry, c_custkey FROM customer)"""
OBS_SQL = f"""{COMPANY_SQL}, obs AS (
    SELECT row_number() OVER (ORDER BY company_name, o_orderpriority, o_orderstatus,
                                       o_orderdate, o_orderkey) AS seq,
           'ART' || printf('%04d', o_orderkey) AS article_id, company_id,
           CAST(o_orderdate AS DATE) AS d, year(o_orderdate) AS y, quarter(o_orderdate) AS q,
           CAST(floor(o_totalprice / 1000) AS BIGINT) AS m
    FROM orders JOIN company ON o_custkey = c_custkey WHERE o_orderkey % 4 <> 0)"""
ROLLUP_SQL = f"""{OBS_SQL}, rollup_q AS (
    SELECT company_id, y AS observation_year, q AS observation_quarter,
           count(*) AS observations_count, last(m ORDER BY seq) AS "latest_arr_usd_M",
           round_even(avg(m), 1) AS "avg_arr_usd_M", max(m) AS "max_arr_usd_M",
           min(m) AS "min_arr_usd_M"
    FROM obs GROUP BY ALL)"""
LATEST_SQL = f"""{OBS_SQL}, latest AS (
    SELECT company_id, company_name, industry,
           'ARR' || printf('%04d', last(seq ORDER BY y, q, seq)) AS latest_observation_id,
           last(article_id ORDER BY y, q, seq) AS latest_article_id,
           strftime(last(d ORDER BY y, q, seq), '%Y-%m-%d') AS latest_observation_date,
           last(m ORDER BY y, q, seq) AS "latest_arr_usd_M",
           count(seq) AS total_observations_recorded
    FROM company JOIN obs USING (company_id) GROUP BY ALL
    UNION ALL
    SELECT company_id, company_name, industry, NULL, NULL, NULL, NULL, NULL
    FROM company WHERE company_id NOT IN (SELECT company_id FROM obs))"""


@query(
    "dim_first_nonnull",
    f"""WITH {COMPANY_SQL}
        SELECT company_id, company_name,
               first(p ORDER BY o_orderdate, o_orderkey) FILTER (p IS NOT NULL) AS industry,
               first(s ORDER BY o_orderdate, o_orderkey) FILTER (s IS NOT NULL) AS headquarters
        FROM (SELECT *, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS p,
                     CASE WHEN o_orderkey % 4 = 1 THEN o_orderstatus END AS s FROM orders)
        JOIN company ON o_custkey = c_custkey GROUP BY ALL""",
)
def dim_first_nonnull(t):
    rows = silver(t).select(
        "company_name", "published_date", "o_orderkey",
        F.when(F.col("o_orderkey") % 3 != 0, F.col("category_clean")).alias("industry"),
        F.when(F.col("o_orderkey") % 4 == 1, F.col("author")).alias("headquarters"),
    )
    return star.build_dimension(
        rows, company_keys(t), "company_name", "company_id", ["industry", "headquarters"],
        ["published_date", "o_orderkey"],
    )


@query(
    "dedup_first",
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
)
def dedup_first(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    return first_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "star_articles",
    f"""WITH {COMPANY_SQL}
        SELECT 'ART' || printf('%04d', o_orderkey) AS article_id, company_id,
               o_orderpriority AS category_clean, o_orderstatus AS author,
               strftime(o_orderdate, '%d-%m-%Y') AS published_date_clean,
               year(o_orderdate) AS published_year, quarter(o_orderdate) AS published_quarter,
               month(o_orderdate) AS published_month,
               strftime(o_orderdate, '%Y-%m') AS published_year_month,
               o_orderkey % 700 AS word_count
        FROM orders LEFT JOIN company ON o_custkey = c_custkey""",
)
def star_articles(t):
    return star.build_fact(
        silver(t), company_keys(t), "company_name", "company_id",
        ["article_id", "company_id", "category_clean", "author", "published_date_clean",
         "published_year", "published_quarter", "published_month", "published_year_month",
         "word_count"],
    )


@query(
    "star_observations",
    f"""WITH {OBS_SQL}
        SELECT 'ARR' || printf('%04d', seq) AS observation_id, article_id, company_id,
               strftime(d, '%Y-%m-%d') AS observation_date, y AS observation_year,
               q AS observation_quarter, strftime(d, '%Y-%m') AS observation_year_month,
               m AS "arr_usd_M", m * 1000000 AS arr_usd FROM obs""",
)
def star_observations(t):
    return observations(t).drop("_seq").withColumn("observation_date", day_text("observation_date"))


@query(
    "sequence_ids",
    """SELECT row_number() OVER (ORDER BY o_custkey, o_orderdate, o_orderkey) AS seq,
              o_custkey, o_orderkey FROM orders""",
)
def sequence_ids(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return ordered.dense_sequence(rows, ["o_custkey", "o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "row_positions",
    "SELECT event_id, user_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS original_index FROM events",
)
def row_positions(t):
    rows = t.events.select("event_id", "user_id", "ts")
    return ordered.dense_sequence(rows, ["ts", "event_id"], "original_index", start=0).drop("ts")


def rollup(t):
    # "latest" follows the order of the observations; their numbers are not needed for it
    rows = look_up(silver(t), company_keys(t), "company_name", ["company_id"])
    rows = rows.filter("arr_usd_M IS NOT NULL").withColumnsRenamed(
        {"published_year": "observation_year", "published_quarter": "observation_quarter"}
    )
    return star.quarterly_rollup(rows, companies(t), "company_id", "arr_usd_M", SILVER_ORDER)


def latest(t, count_default=None):
    return star.latest_view(
        observations(t), companies(t), "company_id", [*PERIOD, "_seq"],
        {
            "observation_id": "latest_observation_id",
            "article_id": "latest_article_id",
            "observation_date": "latest_observation_date",
            "arr_usd_M": "latest_arr_usd_M",
        },
        ["company_name", "industry"],
        count_default=count_default,
    )


@query(
    "quarterly_rollup",
    f"WITH {ROLLUP_SQL} SELECT rollup_q.*, company_name, industry FROM rollup_q JOIN company USING (company_id)",
)
def quarterly_rollup(t):
    return rollup(t)


@query("latest_view", f"WITH {LATEST_SQL} SELECT * FROM latest")
def latest_view(t):
    return latest(t).withColumn("latest_observation_date", day_text("latest_observation_date"))


@query(
    "qoq_growth",
    f"""WITH {ROLLUP_SQL}
        SELECT *, round(CAST((value - previous_value) AS DOUBLE) * 100 / nullif(previous_value, 0), 2) AS growth_pct
        FROM (SELECT company_id, observation_year, observation_quarter, "latest_arr_usd_M" AS value,
                     lag("latest_arr_usd_M") OVER (PARTITION BY company_id
                         ORDER BY observation_year, observation_quarter) AS previous_value
              FROM rollup_q)""",
)
def qoq_growth(t):
    quarters = rollup(t).select("company_id", *PERIOD, F.col("latest_arr_usd_M").alias("value"))
    return analytics.period_growth(quarters, "company_id", PERIOD, "value")


@query(
    "top_latest",
    f"""WITH {LATEST_SQL} SELECT company_name, "latest_arr_usd_M" FROM latest
        ORDER BY "latest_arr_usd_M" DESC NULLS LAST, company_name LIMIT 5""",
)
def top_latest(t):
    view = latest(t).select("company_name", "latest_arr_usd_M")
    return top(view, [F.desc_nulls_last("latest_arr_usd_M"), F.col("company_name")], 5)


@query(
    "member_trend",
    f"""WITH {ROLLUP_SQL} SELECT observation_year, observation_quarter, "latest_arr_usd_M"
        FROM rollup_q JOIN company USING (company_id) WHERE company_name = 'Customer#000000007'
        ORDER BY 1, 2""",
)
def member_trend(t):
    return (
        rollup(t)
        .filter(F.col("company_name") == "Customer#000000007")
        .select(*PERIOD, "latest_arr_usd_M")
        .orderBy(*PERIOD)
    )


@query(
    "semi_cohort",
    f"""WITH {LATEST_SQL}
        SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_custkey IN
            (SELECT c_custkey FROM company JOIN latest USING (company_id) WHERE "latest_arr_usd_M" > 400)""",
)
def semi_cohort_query(t):
    high = latest(t).filter("latest_arr_usd_M > 400").select("company_name")
    urgent = silver(t).filter("category_clean = '1-URGENT'")
    return semi_cohort(urgent, high, "company_name", "company_name").select("o_orderkey", "o_custkey")

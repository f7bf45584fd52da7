"""Slowly changing dimension queries over customers and their orders."""

from pyspark.sql import functions as F

from tidemark.operators import scd
from tidemark.operators.mapping import look_up
from tidemark.operators.rows import first_per_key, last_per_key
from tidemark.operators.scd import Tier, Version
from tidemark.session import durable
from tidemark.workload.analytics import SPEND_SQL, spend
from tidemark.workload.registry import day_text, query

TIERS = (
    Tier("Platinum", 2_200_000, (
        Version("Silver", 10_000, "1996-01-01", "1997-06-30"),
        Version("Gold", 25_000, "1997-07-01", "1998-03-31"),
        Version("Platinum", 50_000, "1998-04-01"),
    )),
    Tier("Gold", 1_500_000, (
        Version("Bronze", 5_000, "1996-01-01", "1997-12-31"),
        Version("Gold", 20_000, "1998-01-01"),
    )),
    Tier("Bronze", 0, (Version("Bronze", 5_000, "1996-01-01"),)),
)
CUT = "1998-01-01"


def scd1(t):
    customers = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("company_name"))
    wide = look_up(customers, spend(t), "customer_id", ["lifetime_spend"], "o_custkey")
    names = ("loyalty_tier", "credit_limit_usd", "last_updated_at")
    tiers = scd.tier_columns(F.col("lifetime_spend"), TIERS, names)
    return wide.withColumns(tiers).drop("lifetime_spend")


def scd2(t):
    final = scd1(t).select("customer_id", "company_name", F.col("loyalty_tier").alias("final_tier"))
    return scd.planned_versions(final, "final_tier", TIERS)


SCD1_SQL = f"""{SPEND_SQL}, scd1 AS (
    SELECT c_custkey AS customer_id, c_name AS company_name,
           CASE WHEN coalesce(lifetime_spend, 0) >= 2200000 THEN 'Platinum'
                WHEN coalesce(lifetime_spend, 0) >= 1500000 THEN 'Gold' ELSE 'Bronze' END AS loyalty_tier
    FROM customer LEFT JOIN spend ON c_custkey = o_custkey)"""
SCD2_SQL = f"""{SCD1_SQL}, scd2 AS (
    SELECT customer_id, company_name, v.tier AS loyalty_tier, v.credit AS credit_limit_usd, v.s, v.e
    FROM scd1 JOIN (VALUES
        ('Platinum', 'Silver', 10000, DATE '1996-01-01', DATE '1997-06-30'),
        ('Platinum', 'Gold', 25000, DATE '1997-07-01', DATE '1998-03-31'),
        ('Platinum', 'Platinum', 50000, DATE '1998-04-01', DATE '9999-12-31'),
        ('Gold', 'Bronze', 5000, DATE '1996-01-01', DATE '1997-12-31'),
        ('Gold', 'Gold', 20000, DATE '1998-01-01', DATE '9999-12-31'),
        ('Bronze', 'Bronze', 5000, DATE '1996-01-01', DATE '9999-12-31')) v(final, tier, credit, s, e)
        ON loyalty_tier = v.final)"""


@query(
    "scd1_tier",
    f"""WITH {SCD1_SQL} SELECT *,
            CASE loyalty_tier WHEN 'Platinum' THEN 50000 WHEN 'Gold' THEN 20000 ELSE 5000 END AS credit_limit_usd,
            CASE loyalty_tier WHEN 'Platinum' THEN '1998-04-01' WHEN 'Gold' THEN '1998-01-01'
                 ELSE '1996-01-01' END AS last_updated_at
        FROM scd1""",
)
def scd1_tier(t):
    return scd1(t)


@query(
    "scd2_versions",
    f"""WITH {SCD2_SQL}
        SELECT 'CUST_SK_' || printf('%04d', row_number() OVER (ORDER BY customer_id, s)) AS customer_sk,
               customer_id, company_name, loyalty_tier, credit_limit_usd,
               strftime(s, '%Y-%m-%d') AS effective_start_date,
               CASE WHEN e = DATE '9999-12-31' THEN '9999-12-31' ELSE strftime(e, '%Y-%m-%d') END AS effective_end_date,
               e = DATE '9999-12-31' AS is_current_flag
        FROM scd2""",
)
def scd2_versions(t):
    return dates_as_text(scd.version_keys(scd2(t), ["customer_id"]))


def dates_as_text(df):
    return df.withColumns({c: day_text(c) for c in (scd.START, scd.END)})


@query(
    "scd3_previous",
    f"""WITH {SCD1_SQL} SELECT customer_id, loyalty_tier,
            CASE loyalty_tier WHEN 'Platinum' THEN 'Gold' WHEN 'Gold' THEN 'Bronze' END AS previous_loyalty_tier,
            CASE loyalty_tier WHEN 'Platinum' THEN 25000 WHEN 'Gold' THEN 5000 END AS previous_credit_limit_usd,
            CASE loyalty_tier WHEN 'Platinum' THEN '1998-04-01' WHEN 'Gold' THEN '1998-01-01' END AS tier_change_date
        FROM scd1""",
)
def scd3_previous(t):
    dim = scd.with_previous_tier(scd1(t), TIERS).withColumn("tier_change_date", day_text("tier_change_date"))
    return dim.drop("company_name", "credit_limit_usd", "last_updated_at")


def feed(t, test=None):
    """Order status and priority as a change feed per customer."""
    rows = t.orders.select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").cast("date").alias("changed_on"),
        F.col("o_orderkey").alias("seq"),
    )
    return rows.filter(test) if test else rows


OLD, NEW = f"changed_on < DATE '{CUT}'", f"changed_on >= DATE '{CUT}'"
FEED_SQL = """feed AS (
    SELECT o_custkey AS customer_id, o_orderstatus AS status, o_orderpriority AS priority,
           CAST(o_orderdate AS DATE) AS changed_on, o_orderkey AS seq FROM orders)"""


@query(
    "scd0_first_seen",
    f"""WITH {FEED_SQL} SELECT customer_id, status, priority, strftime(changed_on, '%Y-%m-%d') AS changed_on
        FROM feed QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY changed_on, seq) = 1""",
)
def scd0_first_seen(t):
    existing = first_per_key(feed(t, OLD), ["customer_id"], ["changed_on", "seq"])
    kept = scd.retain_original(existing, feed(t, NEW), ["customer_id"], ["changed_on", "seq"])
    return kept.drop("seq").withColumn("changed_on", day_text("changed_on"))


@query(
    "scd1_overwrite",
    f"""WITH {FEED_SQL} SELECT customer_id, status, priority, strftime(changed_on, '%Y-%m-%d') AS changed_on
        FROM feed QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY changed_on DESC, seq DESC) = 1""",
)
def scd1_overwrite(t):
    existing = last_per_key(feed(t, OLD), ["customer_id"], ["changed_on", "seq"])
    kept = scd.overwrite_current(existing, feed(t, NEW), ["customer_id"], ["changed_on", "seq"])
    return kept.drop("seq").withColumn("changed_on", day_text("changed_on"))


HISTORY_SQL = f"""{FEED_SQL}, days AS (
    SELECT customer_id, changed_on, last(status ORDER BY seq) AS status, last(priority ORDER BY seq) AS priority
    FROM feed GROUP BY ALL),
kept AS (
    SELECT * FROM days QUALIFY status IS DISTINCT FROM lag(status) OVER (PARTITION BY customer_id ORDER BY changed_on)),
history AS (
    SELECT customer_id, status, priority, changed_on AS s,
           lead(changed_on) OVER (PARTITION BY customer_id ORDER BY changed_on) - 1 AS e FROM kept)"""


def history(t):
    known = scd.history_of(
        feed(t, OLD), ["customer_id"], ["status"], "changed_on", ["seq"], "customer_sk", ["priority"]
    )
    return scd.apply_changes(
        known, feed(t, NEW), ["customer_id"], ["status"], "changed_on", ["seq"], "customer_sk"
    )


@query(
    "scd2_incremental",
    f"""WITH {HISTORY_SQL}
        SELECT 'CUST_SK_' || printf('%04d', row_number() OVER (ORDER BY s >= DATE '{CUT}', customer_id, s)) AS customer_sk,
               customer_id, status, priority, strftime(s, '%Y-%m-%d') AS effective_start_date,
               coalesce(strftime(e, '%Y-%m-%d'), '9999-12-31') AS effective_end_date,
               e IS NULL AS is_current_flag
        FROM history""",
)
def scd2_incremental(t):
    return dates_as_text(history(t))


@query(
    "scd3_shift",
    f"""WITH {FEED_SQL},
        old AS (SELECT * FROM feed WHERE {OLD}
                QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY changed_on DESC, seq DESC) = 1),
        new AS (SELECT * FROM feed WHERE {NEW}
                QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY changed_on DESC, seq DESC) = 1)
        SELECT customer_id,
               CASE WHEN new.status IS NOT NULL AND new.status <> old.status THEN new.status ELSE old.status END AS current_status,
               CASE WHEN new.status IS NOT NULL AND new.status <> old.status THEN old.status END AS previous_status,
               CASE WHEN new.status IS NOT NULL AND new.status <> old.status
                    THEN strftime(new.changed_on, '%Y-%m-%d') END AS change_date
        FROM old LEFT JOIN new USING (customer_id)""",
)
def scd3_shift(t):
    newest = ["changed_on", "seq"]
    base = last_per_key(feed(t, OLD), ["customer_id"], newest).select(
        "customer_id", F.col("status").alias("current_status"),
        F.lit(None).cast("string").alias("previous_status"), F.lit(None).cast("date").alias("change_date"),
    )
    updates = last_per_key(feed(t, NEW), ["customer_id"], newest).withColumnRenamed("status", "current_status")
    shifted = scd.shift_previous(
        base, updates, ["customer_id"], {"current_status": "previous_status"}, "change_date", "changed_on"
    )
    return shifted.withColumn("change_date", day_text("change_date"))


@query(
    "current_snapshot",
    f"WITH {HISTORY_SQL} SELECT customer_id, status FROM history WHERE e IS NULL",
)
def current_snapshot(t):
    whole = scd.history_of(feed(t), ["customer_id"], ["status"], "changed_on", ["seq"])
    return scd.current_versions(whole).select("customer_id", "status")


@query(
    "asof_snapshot",
    f"""WITH {SCD2_SQL} SELECT customer_id, loyalty_tier, credit_limit_usd FROM scd2
        WHERE DATE '1997-10-01' BETWEEN s AND e""",
)
def asof_snapshot(t):
    return scd.as_of(scd2(t), "1997-10-01").select("customer_id", "loyalty_tier", "credit_limit_usd")


@query(
    "pit_lookup",
    f"""WITH {SCD2_SQL} SELECT customer_id, loyalty_tier, credit_limit_usd FROM scd2
        WHERE customer_id = 4 AND DATE '1998-05-01' BETWEEN s AND e""",
)
def pit_lookup(t):
    found = scd.point_in_time(scd2(t), "customer_id", 4, "1998-05-01")
    return found.select("customer_id", "loyalty_tier", "credit_limit_usd")


@query(
    "temporal_join",
    f"""WITH {SCD2_SQL} SELECT o_orderkey, o_custkey, loyalty_tier, credit_limit_usd
        FROM orders JOIN scd2 ON o_custkey = customer_id AND CAST(o_orderdate AS DATE) BETWEEN s AND e""",
)
def temporal_join(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    # a stored dimension: its size is known, and AQE can split a hot customer
    return scd.temporal_join(
        orders, durable(scd2(t), "scd2"), "o_custkey", "o_orderdate", ["loyalty_tier", "credit_limit_usd"], "customer_id"
    ).drop("o_orderdate")

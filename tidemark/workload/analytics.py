"""Analytical queries."""

from pyspark.sql import functions as F

from tidemark.functions.numbers import size_bucket, stock_status
from tidemark.functions.text import label
from tidemark.operators import analytics
from tidemark.operators.compare import table_diff, union_all
from tidemark.operators.mapping import look_up
from tidemark.operators.ordered import dense_sequence
from tidemark.operators.rows import bounded, top, top_per_group
from tidemark.workload.registry import query
from tidemark.workload.star import silver

SPEND_SQL = """order_net AS (
    SELECT l_orderkey, round(sum(CAST(l_extendedprice AS DECIMAL(18,2)) *
                                 (1 - CAST(l_discount AS DECIMAL(6,2)))), 2) AS net
    FROM lineitem GROUP BY l_orderkey),
spend AS (
    SELECT o_custkey, round(sum(net), 2) AS lifetime_spend
    FROM orders JOIN order_net ON o_orderkey = l_orderkey GROUP BY o_custkey)"""


def spend(t):
    return analytics.lifetime_spend(
        t.orders, t.lineitem, "o_custkey", "o_orderkey", "l_orderkey", "l_extendedprice", "l_discount"
    )


@query(
    "customer_spend",
    f"WITH {SPEND_SQL} SELECT o_custkey, CAST(lifetime_spend AS DOUBLE) AS lifetime_spend FROM spend",
)
def customer_spend(t):
    return spend(t).withColumn("lifetime_spend", F.col("lifetime_spend").cast("double"))


@query(
    "star_summary",
    """SELECT c_mktsegment AS industry, count(DISTINCT c_custkey) AS total_companies,
              count(o_orderkey) AS total_articles, round(avg(l_quantity), 1) AS "avg_arr_usd_M",
              max(l_quantity) AS "max_arr_usd_M"
       FROM customer LEFT JOIN orders ON c_custkey = o_custkey
            LEFT JOIN lineitem ON o_orderkey = l_orderkey
       GROUP BY c_mktsegment""",
)
def star_summary(t):
    out = analytics.star_summary(
        t.customer, t.orders, t.lineitem, "c_mktsegment", "c_custkey", "o_custkey", "o_orderkey",
        "l_orderkey", "l_quantity",
    )
    return out.withColumnRenamed("c_mktsegment", "industry").orderBy(F.desc("total_articles"))


@query(
    "top_peak",
    """SELECT c_name, max(o_totalprice) AS peak FROM orders JOIN customer ON o_custkey = c_custkey
       GROUP BY c_name ORDER BY peak DESC, c_name LIMIT 5""",
)
def top_peak(t):
    members = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return analytics.peak_by_member(t.orders, members, "o_custkey", "c_name", "o_totalprice", 5)


@query(
    "value_counts",
    "SELECT o_orderpriority, count(*) AS articles FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1",
)
def value_counts(t):
    return analytics.value_counts(t.orders, "o_orderpriority", "articles")


@query(
    "top_categories",
    "SELECT source, count(*) AS documents FROM documents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3",
)
def top_categories(t):
    return analytics.value_counts(t.documents, "source", "documents").limit(3)


@query(
    "members_by_location",
    """SELECT c_name, c_mktsegment AS industry FROM customer JOIN nation ON c_nationkey = n_nationkey
       WHERE n_name = 'NATION_3'""",
)
def members_by_location(t):
    located = look_up(t.customer, t.nation, "c_nationkey", {"n_name": "headquarters"}, "n_nationkey")
    return located.filter(F.col("headquarters") == "NATION_3").select(
        "c_name", F.col("c_mktsegment").alias("industry")
    )


def wide(t):
    """Facts with the attributes the profiles group by."""
    rows = look_up(silver(t), t.nation, "nation", {"n_name": "headquarters"}, "n_nationkey")
    employees = F.when(F.col("o_custkey") % 7 != 0, F.floor(F.col("balance") * 5))
    return (
        rows.withColumn("employee_count", employees)
        .withColumn("size_category", size_bucket(F.col("employee_count")))
        .withColumn("company_age", F.col("published_year") - (1950 + F.col("o_custkey") % 40))
    )


WIDE_SQL = """wide AS (
    SELECT o_orderkey, o_custkey, c_name, c_mktsegment AS industry, o_orderpriority AS category_clean,
           o_orderstatus AS author, n_name AS headquarters, year(o_orderdate) AS y,
           CASE WHEN o_orderkey % 4 <> 0 THEN CAST(floor(o_totalprice / 1000) AS BIGINT) END AS m,
           o_orderkey % 700 AS words,
           CASE WHEN o_custkey % 7 <> 0 THEN CAST(floor(c_acctbal * 5) AS BIGINT) END AS employees,
           year(o_orderdate) - (1950 + o_custkey % 40) AS age
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
         LEFT JOIN nation ON c_nationkey = n_nationkey)"""


@query(
    "profile_industry",
    f"""WITH {WIDE_SQL} SELECT industry, count(o_orderkey) AS total_articles,
            count(DISTINCT c_name) AS total_companies, round_even(avg(m), 1) AS avg_revenue,
            median(m) AS median_revenue, max(m) AS max_revenue, round_even(avg(words), 0) AS avg_words
        FROM wide GROUP BY industry""",
)
def profile_industry(t):
    return analytics.profile(
        wide(t), "industry", {"total_articles": "o_orderkey"}, {"total_companies": "company_name"},
        {"avg_revenue": ("arr_usd_M", 1), "avg_words": ("word_count", 0)},
        maxima={"max_revenue": "arr_usd_M"}, medians={"median_revenue": "arr_usd_M"},
    ).orderBy(F.desc("total_articles"))


@query(
    "profile_category",
    f"""WITH {WIDE_SQL} SELECT category_clean, count(o_orderkey) AS total_articles,
            count(DISTINCT c_name) AS distinct_companies, round_even(avg(m), 1) AS avg_revenue,
            round_even(avg(words), 0) AS avg_words, min(y) AS earliest, max(y) AS latest
        FROM wide GROUP BY category_clean""",
)
def profile_category(t):
    return analytics.profile(
        wide(t), "category_clean", {"total_articles": "o_orderkey"},
        {"distinct_companies": "company_name"},
        {"avg_revenue": ("arr_usd_M", 1), "avg_words": ("word_count", 0)},
        maxima={"latest": "published_year"}, minima={"earliest": "published_year"},
    ).orderBy(F.desc("total_articles"))


@query(
    "profile_author",
    f"""WITH {WIDE_SQL} SELECT author, count(o_orderkey) AS articles_published,
            count(DISTINCT c_name) AS companies_covered, round_even(avg(words), 0) AS avg_words,
            round_even(avg(m), 1) AS avg_revenue
        FROM wide GROUP BY author ORDER BY 2 DESC, 1 LIMIT 10""",
)
def profile_author(t):
    profiled = analytics.profile(
        wide(t), "author", {"articles_published": "o_orderkey"},
        {"companies_covered": "company_name"},
        {"avg_words": ("word_count", 0), "avg_revenue": ("arr_usd_M", 1)},
    )
    return top(profiled, [F.desc("articles_published"), F.col("author")], 10)


@query(
    "profile_location",
    f"""WITH {WIDE_SQL} SELECT headquarters, count(DISTINCT c_name) AS companies_count,
            count(o_orderkey) AS articles_count, round_even(avg(employees), 0) AS avg_employees,
            round_even(avg(m), 1) AS avg_revenue
        FROM wide GROUP BY headquarters""",
)
def profile_location(t):
    return analytics.profile(
        wide(t), "headquarters", {"articles_count": "o_orderkey"},
        {"companies_count": "company_name"},
        {"avg_employees": ("employee_count", 0), "avg_revenue": ("arr_usd_M", 1)},
    ).orderBy(F.desc("companies_count"))


@query(
    "profile_size",
    f"""WITH {WIDE_SQL} SELECT CASE WHEN employees IS NULL THEN 'Unknown' WHEN employees < 10000
                    THEN 'Small' WHEN employees <= 30000 THEN 'Medium' ELSE 'Large' END AS size_category,
            count(DISTINCT c_name) AS distinct_companies, count(o_orderkey) AS total_articles,
            round_even(avg(employees), 0) AS avg_employees, round_even(avg(m), 1) AS avg_revenue,
            round_even(avg(age), 1) AS avg_age
        FROM wide GROUP BY 1""",
)
def profile_size(t):
    return analytics.profile(
        wide(t), "size_category", {"total_articles": "o_orderkey"},
        {"distinct_companies": "company_name"},
        {"avg_employees": ("employee_count", 0), "avg_revenue": ("arr_usd_M", 1),
         "avg_age": ("company_age", 1)},
    ).orderBy(F.desc("distinct_companies"))


RFM_SQL = f"""{SPEND_SQL}, metrics AS (
    SELECT o_custkey, date_diff('day', max(CAST(o_orderdate AS DATE)),
               (SELECT max(CAST(o_orderdate AS DATE)) + 1 FROM orders JOIN order_net ON o_orderkey = l_orderkey)) AS recency_days,
           count(DISTINCT o_orderkey) AS frequency_orders_count, sum(net) AS money
    FROM orders JOIN order_net ON o_orderkey = l_orderkey GROUP BY o_custkey),
scores AS (
    SELECT o_custkey, recency_days, frequency_orders_count,
           CAST(money AS DOUBLE) AS monetary_total_spend,
           5 - ntile(4) OVER (ORDER BY recency_days, o_custkey) AS r_score,
           ntile(4) OVER (ORDER BY frequency_orders_count, o_custkey) AS f_score,
           ntile(4) OVER (ORDER BY money, o_custkey) AS m_score FROM metrics)"""


def scores(t):
    totals = analytics.order_totals(t.lineitem, "l_orderkey", "l_extendedprice", "l_discount", "net")
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate").join(
        totals, F.col("o_orderkey") == F.col("l_orderkey"), "inner"
    )
    metrics = analytics.rfm_metrics(orders, "o_custkey", "o_orderkey", "o_orderdate", "net")
    return analytics.rfm_scores(metrics, "o_custkey").withColumn(
        "monetary_total_spend", F.col("monetary_total_spend").cast("double")
    )


@query(
    "rfm_scores",
    f"WITH {RFM_SQL} SELECT *, r_score * 100 + f_score * 10 + m_score AS rfm_combined_score FROM scores",
)
def rfm_scores(t):
    return scores(t)


@query(
    "rfm_segments",
    f"""WITH {RFM_SQL}, named AS (
            SELECT CASE WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Champions'
                        WHEN r_score >= 3 AND f_score >= 2 AND m_score >= 2 THEN 'Loyal Customers'
                        WHEN r_score >= 3 THEN 'Recent Customers'
                        WHEN r_score = 1 AND f_score >= 3 AND m_score >= 3 THEN 'At Risk - High Spenders'
                        WHEN r_score = 1 AND f_score <= 2 AND m_score = 1 THEN 'Lost Customers'
                        ELSE 'Promising / Needs Attention' END AS customer_segment FROM scores)
        SELECT customer_segment, count(*) AS customers FROM named GROUP BY 1""",
)
def rfm_segments(t):
    return analytics.value_counts(analytics.rfm_segments(scores(t)), "customer_segment", "customers")


@query(
    "stock_status",
    """SELECT 'PROD_SK_' || printf('%03d', row_number() OVER (ORDER BY p_partkey)) AS product_sk,
              p_partkey AS product_id, s_name AS category_name, units AS units_in_stock, reorder_level,
              CASE WHEN units = 0 THEN 'Out of Stock' WHEN units <= reorder_level THEN 'Low Stock'
                   ELSE 'In Stock' END AS stock_status
       FROM (SELECT p_partkey, p_partkey % 23 AS units, p_size % 10 AS reorder_level FROM part)
            LEFT JOIN supplier ON s_suppkey = p_partkey % 100""",
)
def stock_status_query(t):
    parts = t.part.selectExpr(
        "p_partkey AS product_id", "p_partkey % 23 AS units_in_stock", "p_size % 10 AS reorder_level",
        "p_partkey % 100 AS category_id",
    )
    named = look_up(parts, t.supplier, "category_id", {"s_name": "category_name"}, "s_suppkey")
    numbered = dense_sequence(named, ["product_id"], "_n")
    return numbered.select(
        label("PROD_SK_", F.col("_n"), 3).alias("product_sk"), "product_id", "category_name",
        "units_in_stock", "reorder_level",
        stock_status(F.col("units_in_stock"), F.col("reorder_level")).alias("stock_status"),
    )


@query(
    "top_per_group",
    """SELECT o_orderpriority, o_orderkey, rank FROM (
           SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank
           FROM orders) WHERE rank <= 5""",
)
def top_per_group_query(t):
    rows = t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice")
    ranked = top_per_group(rows, ["o_orderpriority"], [F.desc("o_totalprice"), F.col("o_orderkey")], 5)
    return ranked.drop("o_totalprice")


@query(
    "bounded_result",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def bounded_result(t):
    ranked = t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return bounded(ranked, 5000)


@query(
    "union_files",
    """SELECT o_orderstatus, count(*) AS orders, count(o_custkey) AS with_customer,
              count(CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END) AS with_priority
       FROM orders GROUP BY 1""",
)
def union_files(t):
    parts = [
        t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderstatus"),
        t.orders.filter("o_orderstatus <> 'F'").select(
            "o_orderpriority", "o_orderstatus", "o_orderkey", "o_custkey"
        ),
    ]
    return union_all(parts).groupBy("o_orderstatus").agg(
        F.count("o_orderkey").alias("orders"),
        F.count("o_custkey").alias("with_customer"),
        F.count("o_orderpriority").alias("with_priority"),
    )


@query(
    "table_diff",
    """SELECT o_custkey, o_orderstatus, CAST(sum(n) AS BIGINT) AS copies FROM (
           SELECT o_custkey, o_orderstatus, -1 AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
           UNION ALL
           SELECT o_custkey, o_orderstatus, 1 FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
       GROUP BY 1, 2 HAVING sum(n) <> 0""",
)
def table_diff_query(t):
    pair = t.orders.select("o_custkey", "o_orderstatus", "o_orderdate")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    old = pair.filter(F.col("o_orderdate") < cut).drop("o_orderdate")
    new = pair.filter(F.col("o_orderdate") >= cut).drop("o_orderdate")
    return table_diff(old, new)

"""Cleaning queries: messy text is derived from the tables by row key."""

from pyspark.sql import functions as F

from tidemark.functions import dates, money, numbers, text
from tidemark.operators import filters, mapping
from tidemark.operators.rows import distinct_rows
from tidemark.workload.registry import query

# Both dialects read this text, so the raw input is the same on both sides.
RAW_NAME = """CASE c_custkey % 6
    WHEN 0 THEN '  ' || c_name || chr(9)
    WHEN 1 THEN 'nan'
    WHEN 2 THEN ' None '
    WHEN 3 THEN '   '
    WHEN 4 THEN NULL
    ELSE c_name END"""
CLEAN_NAME_SQL = f"""
    SELECT c_custkey,
           CASE WHEN bare NOT IN ('nan', 'None', '') THEN bare END AS name_clean,
           coalesce(CASE WHEN bare NOT IN ('nan', 'None', '') THEN bare END, 'Unknown') AS author
    FROM (SELECT c_custkey,
                 regexp_replace({RAW_NAME}, '^\\s+|\\s+$', '', 'g') AS bare FROM customer)"""


@query("string_hygiene", CLEAN_NAME_SQL)
def string_hygiene(t):
    raw = t.customer.select("c_custkey", F.expr(RAW_NAME).alias("name_clean"))
    clean = text.clean_text_columns(raw, ["name_clean", "no_such_column"])
    return clean.withColumn("author", F.coalesce("name_clean", F.lit("Unknown")))


RAW_CITY = "CASE c_custkey % 5 WHEN 0 THEN NULL ELSE '  ' || c_mktsegment || ' ' END"


@query(
    "trim_default",
    f"""SELECT c_custkey AS customer_id, trim(c_name || '  ') AS company_name,
               coalesce(trim({RAW_CITY}), 'Unknown') AS city,
               coalesce(trim({RAW_CITY}), 'N/A') AS region
        FROM customer""",
)
def trim_default(t):
    city = F.expr(RAW_CITY)
    return t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        text.trimmed(F.expr("c_name || '  '")).alias("company_name"),
        text.trimmed(city, "Unknown").alias("city"),
        text.trimmed(city, "N/A").alias("region"),
    )


RAW_NATION = """CASE c_custkey % 4
    WHEN 0 THEN n_name
    WHEN 1 THEN n_name || ' Inc.'
    WHEN 2 THEN 'The ' || n_name
    ELSE 'Other ' || n_name END"""


@query(
    "alias_resolve",
    f"""SELECT c_custkey, raw_name,
               CASE WHEN raw_name LIKE 'Other %' THEN raw_name ELSE n_name END AS company_name,
               raw_name NOT LIKE 'Other %' AND n_regionkey < 3 AS has_metadata
        FROM (SELECT c_custkey, n_name, n_regionkey, {RAW_NATION} AS raw_name
              FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
)
def alias_resolve(t):
    aliases = t.nation.selectExpr(
        "explode(array(n_name || ' Inc.', 'The ' || n_name)) AS alias", "n_name AS canonical"
    )
    raw = mapping.look_up(t.customer, t.nation, "c_nationkey", ["n_name"], "n_nationkey").select(
        "c_custkey", F.expr(RAW_NATION).alias("raw_name")
    )
    named = mapping.map_values(raw, "raw_name", aliases, "company_name")
    known = t.nation.filter("n_regionkey < 3").select("n_name")
    return mapping.flag_members(named, "company_name", known, "has_metadata")


TYPE_CODES = {
    "ECONOMY": "Basic",
    "SMALL": "Basic",
    "STANDARD": "Core",
    "MEDIUM": "Core",
    "LARGE": "Premium",
}


@query(
    "taxonomy_map",
    """SELECT p_partkey, p_type AS category,
              CASE WHEN p_partkey % 11 = 0 THEN NULL
                   WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'Basic'
                   WHEN p_type IN ('STANDARD', 'MEDIUM') THEN 'Core'
                   WHEN p_type = 'LARGE' THEN 'Premium'
                   ELSE p_type END AS category_clean
       FROM part""",
)
def taxonomy_map(t):
    raw = t.part.select(
        "p_partkey",
        F.col("p_type").alias("category"),
        text.clean_text(F.expr("CASE WHEN p_partkey % 11 = 0 THEN ' ' ELSE p_type || ' ' END")).alias("raw"),
    )
    return mapping.map_values(raw, "raw", TYPE_CODES, "category_clean").drop("raw")


@query(
    "mixed_dates",
    """SELECT o_orderkey, strftime(d, '%d-%m-%Y') AS published_date_clean,
              year(d) AS published_year, quarter(d) AS published_quarter,
              month(d) AS published_month, strftime(d, '%Y-%m') AS published_year_month
       FROM (SELECT o_orderkey, CASE o_orderkey % 9
                 WHEN 5 THEN NULL
                 WHEN 6 THEN CASE WHEN day(o_orderdate) <= 12
                                  THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate))
                                  ELSE CAST(o_orderdate AS DATE) END
                 WHEN 7 THEN NULL
                 WHEN 8 THEN CAST(o_orderdate AS DATE) - 1
                 ELSE CAST(o_orderdate AS DATE) END AS d
             FROM orders)""",
)
def mixed_dates(t):
    raw = F.expr(
        """CASE o_orderkey % 9
             WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd')
             WHEN 1 THEN date_format(o_orderdate, 'MM/dd/yyyy')
             WHEN 2 THEN date_format(o_orderdate, 'dd-MMM-yy')
             WHEN 3 THEN date_format(o_orderdate, 'MMMM d, yyyy')
             WHEN 4 THEN date_format(o_orderdate, "yyyy-MM-dd'T'12:30:00'Z'")
             WHEN 5 THEN 'not a date'
             WHEN 6 THEN date_format(o_orderdate, 'dd/MM/yyyy')
             WHEN 7 THEN NULL
             ELSE date_format(o_orderdate, "yyyy-MM-dd'T'01:00:00+02:00") END"""
    )
    parsed = dates.expand_two_digit_year(dates.parse_date(raw), pivot=68)
    with_date = t.spread("orders").select("o_orderkey", parsed.alias("d"))
    return with_date.withColumns(
        dates.date_parts(F.col("d"), "published", "published_date_clean")
    ).drop("d")


RATES = {"USD": 1.0, "GBP": 1.27, "EUR": 1.1, "JPY": 1 / 150}
RAW_MONEY = """CASE o_orderkey % 10
    WHEN 0 THEN '$' || a
    WHEN 1 THEN '€' || a || ',000'
    WHEN 2 THEN ' £' || a || 'K'
    WHEN 3 THEN '¥' || a || ' million'
    WHEN 4 THEN '$' || a || 'M - $' || (a + 10) || 'M'
    WHEN 5 THEN a || 'M USD'
    WHEN 6 THEN '$' || a || 'M TO $' || (a + 20) || 'M'
    WHEN 7 THEN 'Not disclosed'
    WHEN 8 THEN NULL
    ELSE a || '.5 billion' END"""


@query(
    "money_parse",
    f"""SELECT o_orderkey, raw, currency, amount, usd, CAST(round_even(usd / 1e6, 0) AS BIGINT) AS usd_M,
               CAST(round_even(usd / 1e6, 0) AS BIGINT) * 1000000 AS usd_units
        FROM (SELECT o_orderkey, raw, currency, amount,
                     amount * CASE currency WHEN 'EUR' THEN CAST(1.1 AS DOUBLE)
                                            WHEN 'GBP' THEN CAST(1.27 AS DOUBLE)
                                            WHEN 'JPY' THEN CAST(1 AS DOUBLE) / 150
                                            ELSE 1 END AS usd
              FROM (SELECT o_orderkey, {RAW_MONEY} AS raw,
                           CASE WHEN o_orderkey % 10 IN (7, 8) THEN NULL
                                WHEN o_orderkey % 10 = 1 THEN 'EUR'
                                WHEN o_orderkey % 10 = 2 THEN 'GBP'
                                WHEN o_orderkey % 10 = 3 THEN 'JPY'
                                ELSE 'USD' END AS currency,
                           CAST(CASE o_orderkey % 10
                                WHEN 0 THEN a WHEN 1 THEN a * 1000 WHEN 2 THEN a * 1000
                                WHEN 3 THEN a * 1000000 WHEN 4 THEN (a + 5) * 1000000
                                WHEN 5 THEN a * 1000000 WHEN 6 THEN (a + 10) * 1000000
                                WHEN 9 THEN a * 1000000000 + 500000000
                                ELSE NULL END AS DOUBLE) AS amount
                    FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS a FROM orders)))""",
)
def money_parse(t):
    raw = t.spread("orders").selectExpr("o_orderkey", "CAST(floor(o_totalprice) AS BIGINT) AS a").select(
        "o_orderkey", F.expr(RAW_MONEY).alias("raw")
    )
    read = raw.withColumns(
        {"currency": money.currency_of(F.col("raw")), "amount": money.amount_of(F.col("raw"))}
    )
    usd = read.withColumn("usd", money.convert(F.col("amount"), F.col("currency"), RATES))
    millions = usd.withColumn("usd_M", numbers.to_millions(F.col("usd")))
    return millions.withColumn("usd_units", numbers.from_millions(F.col("usd_M")))


@query(
    "size_bucket",
    """SELECT c_custkey, employees,
              CASE WHEN employees IS NULL THEN 'Unknown' WHEN employees < 10000 THEN 'Small'
                   WHEN employees <= 30000 THEN 'Medium' ELSE 'Large' END AS size_category
       FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0
                    THEN CAST(floor(c_acctbal * 5) AS BIGINT) END AS employees FROM customer)""",
)
def size_bucket(t):
    raw = t.customer.selectExpr(
        "c_custkey",
        "CASE WHEN c_custkey % 7 = 0 THEN 'n/a' ELSE CAST(floor(c_acctbal * 5) AS STRING) END AS e",
    )
    return raw.select("c_custkey", numbers.to_long(F.col("e")).alias("employees")).withColumn(
        "size_category", numbers.size_bucket(F.col("employees"))
    )


@query(
    "feature_diff",
    """SELECT o_orderkey, year(o_orderdate) - CASE WHEN o_custkey % 9 <> 0
                  THEN 1950 + o_custkey % 40 END AS company_age FROM orders""",
)
def feature_diff(t):
    founded = F.expr("CASE WHEN o_custkey % 9 <> 0 THEN 1950 + o_custkey % 40 END")
    return t.orders.select(
        "o_orderkey", (F.year("o_orderdate") - founded).cast("long").alias("company_age")
    )


RAW_NUMBER = """CASE event_id % 8
    WHEN 0 THEN '12d'
    WHEN 1 THEN ''
    WHEN 2 THEN 'NaN'
    WHEN 3 THEN ' ' || CAST(event_id AS STRING) || ' '
    WHEN 4 THEN '-' || CAST(event_id AS STRING) || '.25'
    WHEN 5 THEN '1e3'
    WHEN 6 THEN NULL
    ELSE CAST(event_id AS STRING) END"""


@query(
    "safe_cast",
    """SELECT event_id,
              CAST(CASE event_id % 8 WHEN 3 THEN event_id WHEN 4 THEN -(event_id + 0.25)
                   WHEN 5 THEN 1000 WHEN 7 THEN event_id END AS DOUBLE) AS number,
              CAST(coalesce(CASE event_id % 8 WHEN 3 THEN event_id WHEN 4 THEN -(event_id + 0.25)
                   WHEN 5 THEN 1000 WHEN 7 THEN event_id END, 0) AS DOUBLE) AS number_or_zero,
              CASE WHEN event_id % 3 = 0 THEN true WHEN event_id % 3 = 1 THEN NULL ELSE false END AS flag
       FROM events""",
)
def safe_cast(t):
    raw = F.expr(RAW_NUMBER)
    flag = F.expr("CASE event_id % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'maybe' ELSE 'false' END")
    return t.events.select(
        "event_id",
        numbers.to_double(raw).alias("number"),
        numbers.to_double(raw, 0.0).alias("number_or_zero"),
        numbers.to_bool(flag).alias("flag"),
    )


@query(
    "rounding_pair",
    """SELECT o_orderkey, round_even(v, 1) AS half_even_1, round(v, 1) AS half_away_1,
              round_even(v, 0) AS half_even_0, round(v, 2) AS half_away_2
       FROM (SELECT o_orderkey, floor(o_totalprice) / 4 AS v FROM orders)""",
)
def rounding_pair(t):
    v = F.expr("floor(o_totalprice) / 4")
    return t.orders.select(
        "o_orderkey",
        numbers.round_even(v, 1).alias("half_even_1"),
        numbers.round_away(v, 1).alias("half_away_1"),
        numbers.round_even(v, 0).alias("half_even_0"),
        numbers.round_away(v, 2).alias("half_away_2"),
    )


@query(
    "text_features",
    """SELECT doc_id, coalesce(CASE WHEN doc_id % 5 = 0 THEN NULL ELSE source END, '') || ': ' || lang AS heading,
              len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')) AS word_count
       FROM documents""",
)
def text_features(t):
    source = F.when(F.col("doc_id") % 5 != 0, F.col("source"))
    return t.spread("documents").select(
        "doc_id",
        text.joined(source, F.col("lang")).alias("heading"),
        text.word_count(F.col("text")).alias("word_count"),
    )


@query(
    "cohort_filter",
    """SELECT o_orderkey, o_orderpriority AS category, c_mktsegment AS industry,
              CAST(floor(o_totalprice / 1000) AS BIGINT) AS arr_usd_M,
              CAST(floor(o_totalprice / 1000) AS BIGINT) * 1000000 AS arr_usd
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey
       WHERE (o_orderpriority = '1-URGENT' OR c_mktsegment = 'BUILDING')
         AND year(o_orderdate) BETWEEN 1996 AND 1998 AND floor(o_totalprice / 1000) > 50""",
)
def cohort_filter(t):
    facts = t.orders.select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderpriority").alias("category"),
        F.year("o_orderdate").alias("published_year"),
        F.floor(F.col("o_totalprice") / 1000).alias("arr_usd_M"),
    )
    wide = mapping.look_up(facts, t.customer, "o_custkey", {"c_mktsegment": "industry"}, "c_custkey")
    kept = filters.cohort(
        wide,
        any_of=[("category", "1-URGENT"), ("industry", "BUILDING")],
        between=("published_year", 1996, 1998),
        above=("arr_usd_M", 50),
    )
    return kept.select(
        "o_orderkey", "category", "industry", "arr_usd_M",
        numbers.from_millions(F.col("arr_usd_M")).alias("arr_usd"),
    )


@query("distinct_rows", "SELECT DISTINCT lang, source FROM documents")
def distinct_pairs(t):
    return distinct_rows(t.documents, ["lang", "source"])

"""Contracts, profiles, impact analysis and statement audit."""

from pyspark.sql import functions as F

from tidemark.operators import audit, catalog, contracts
from tidemark.workload.registry import query


def contract_tables(t):
    """Tables with injected violations, by row key."""
    orders = t.orders.selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey END AS o_custkey",
        "CASE WHEN o_orderkey % 400 = 1 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus",
        "CASE WHEN o_orderkey % 300 = 7 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice",
        "CASE WHEN o_orderkey % 250 = 3 THEN NULL ELSE o_orderpriority END AS o_orderpriority",
        "year(o_orderdate) AS o_year",
    )
    return {
        "orders": orders,
        "customer": t.customer.filter("c_custkey % 10 <> 9"),
        "lineitem": t.lineitem,
        "part": t.part,
        "nothing": t.part.limit(0),
    }


RULES = (
    contracts.unique("orders", "o_orderkey"),
    contracts.not_null("orders", "o_custkey"),
    contracts.one_of("orders", "o_orderstatus", ["F", "O", "P"], allow_null=False),
    contracts.one_of("orders", "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]),
    contracts.in_range("orders", "o_totalprice", low=0.0, allow_null=False, target="o_totalprice >= 0"),
    contracts.in_range("orders", "o_year", low=1990, high=2030, target="o_year BETWEEN 1990 AND 2030"),
    contracts.references("orders", "o_custkey", "customer", "c_custkey"),
    contracts.unique("lineitem", "l_orderkey"),
    contracts.references("lineitem", "l_partkey", "part", "p_partkey", allow_null=True),
    contracts.in_range("lineitem", "l_discount", low=0.0, high=1.0),
    contracts.not_null("lineitem", "l_comment"),
    contracts.not_null("nothing", "p_partkey"),
)

CONTRACT_SQL = """o AS (
    SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS ck,
           CASE WHEN o_orderkey % 400 = 1 THEN 'Z' ELSE o_orderstatus END AS st,
           CASE WHEN o_orderkey % 300 = 7 THEN -o_totalprice ELSE o_totalprice END AS price,
           CASE WHEN o_orderkey % 250 <> 3 THEN o_orderpriority END AS pr, year(o_orderdate) AS y
    FROM orders),
counts AS (
    SELECT 0 AS rule, 'orders' AS table_name, 'PRIMARY_KEY' AS constraint_type, 'o_orderkey' AS target,
           count(*) AS checked, count(*) - count(DISTINCT o_orderkey) AS violations,
           ' duplicate keys found' AS bad, 'All # keys are unique' AS good FROM o
    UNION ALL SELECT 1, 'orders', 'NOT_NULL', 'o_custkey', count(*), count(*) - count(ck),
           ' nulls found out of # rows', '0 nulls across # rows' FROM o
    UNION ALL SELECT 2, 'orders', 'ENUM_TAXONOMY', 'o_orderstatus', count(*), count(*) FILTER (st NOT IN ('F', 'O', 'P')),
           ' values outside allowed enum set [''F'', ''O'', ''P'']', 'All # values match allowed categories' FROM o
    UNION ALL SELECT 3, 'orders', 'ENUM_TAXONOMY', 'o_orderpriority', count(pr), 0,
           '', 'All # values match allowed categories' FROM o
    UNION ALL SELECT 4, 'orders', 'CHECK_RANGE', 'o_totalprice >= 0', count(*), count(*) FILTER (price < 0),
           ' values outside bounds [0.0, None]', 'All # values within bounds [0.0, None]' FROM o
    UNION ALL SELECT 5, 'orders', 'CHECK_RANGE', 'o_year BETWEEN 1990 AND 2030', count(*), count(*) FILTER (y NOT BETWEEN 1990 AND 2030),
           ' values outside bounds [1990, 2030]', 'All # values within bounds [1990, 2030]' FROM o
    UNION ALL SELECT 6, 'orders', 'FOREIGN_KEY', 'o_custkey -> customer.c_custkey', count(*),
           count(*) FILTER (ck IS NULL OR ck NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 9)),
           ' orphan FK values not found in parent table', 'All # foreign keys resolve to parent table' FROM o
    UNION ALL SELECT 7, 'lineitem', 'PRIMARY_KEY', 'l_orderkey', count(*), count(*) - count(DISTINCT l_orderkey),
           ' duplicate keys found', 'All # keys are unique' FROM lineitem
    UNION ALL SELECT 8, 'lineitem', 'FOREIGN_KEY', 'l_partkey -> part.p_partkey', count(l_partkey),
           count(*) FILTER (l_partkey NOT IN (SELECT p_partkey FROM part)),
           ' orphan FK values not found in parent table', 'All # foreign keys resolve to parent table' FROM lineitem
    UNION ALL SELECT 9, 'lineitem', 'CHECK_RANGE', 'l_discount', count(*), count(*) FILTER (l_discount NOT BETWEEN 0 AND 1),
           ' values outside bounds [0.0, 1.0]', 'All # values within bounds [0.0, 1.0]' FROM lineitem),
results AS (
    SELECT rule, table_name, constraint_type, target, CASE WHEN violations > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
           round_even((checked - violations) / checked * 100, 2) AS pass_rate_pct, violations,
           CASE WHEN violations > 0 THEN violations || replace(bad, '#', checked || '')
                ELSE replace(good, '#', checked || '') END AS details
    FROM counts
    UNION ALL SELECT 10, 'lineitem', 'NOT_NULL', 'l_comment', 'FAIL', 0, (SELECT count(*) FROM lineitem),
           'Column ''l_comment'' missing from DataFrame')"""


@query("contract_results", f"WITH {CONTRACT_SQL} SELECT * FROM results")
def contract_results(t):
    return contracts.evaluate(contract_tables(t), RULES)


@query(
    "contract_scorecard",
    f"""WITH {CONTRACT_SQL} SELECT CASE WHEN count(*) = count(*) FILTER (status = 'PASS') THEN 'PASSED' ELSE 'FAILED' END AS overall_status,
            round_even(count(*) FILTER (status = 'PASS') * 100 / count(*), 2) AS overall_health_score_pct,
            count(*) AS total_constraints_evaluated, count(*) FILTER (status = 'PASS') AS passed_count,
            count(*) FILTER (status = 'FAIL') AS failed_count FROM results""",
)
def contract_scorecard(t):
    return contracts.scorecard(contracts.evaluate(contract_tables(t), RULES))


#: The columns of the tables that are profiled whole.
PROFILED = {
    "customer": "c_custkey c_name c_nationkey c_mktsegment c_acctbal".split(),
    "documents": "doc_id text lang source n_chars".split(),
    "events": "event_id ts user_id event_type value props".split(),
}


def null_profile_sql():
    """Counts of every column; samples as text (of numbers with fractions none, as the two
    dialects print them differently)."""
    columns = [
        f"""SELECT '{c}' AS c, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct, count(*) AS rows,
               {"''" if c == "c_acctbal" else f"""array_to_string(array_slice(list_sort(
                   list(DISTINCT CAST({c} AS VARCHAR)) FILTER ({c} IS NOT NULL)), 1, 3), ', ')"""} AS samples FROM gaps"""
        for c in PROFILED["customer"]
    ]
    return f"""WITH gaps AS (
        SELECT * REPLACE (CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS c_mktsegment) FROM customer)
    SELECT 'customer' AS table_name, c AS column_name, n_null AS null_count, n_distinct AS distinct_count,
           samples AS sample_values, rows AS row_count FROM ({" UNION ALL ".join(columns)})"""


@query("null_profile", null_profile_sql())
def null_profile(t):
    gaps = F.expr("CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END")
    rows = t.customer.withColumn("c_mktsegment", gaps)
    profile = catalog.profile_columns(rows, "customer").drop("data_type", "nullable", "column_count")
    samples = F.when(F.col("column_name") == "c_acctbal", "").otherwise(F.array_join("sample_values", ", "))
    return profile.withColumn("sample_values", samples)


def table_profiles_sql():
    return " UNION ALL ".join(
        f"""SELECT '{table}.{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
            count(DISTINCT {c}) AS distinct_count FROM {table}"""
        for table in ("documents", "events")
        for c in PROFILED[table]
    )


@query("table_profiles", table_profiles_sql())
def table_profiles(t):
    return catalog.profile_tables({"documents": t.documents, "events": t.events}).select(
        F.concat_ws(".", "table_name", "column_name").alias("column_name"),
        "row_count", "null_count", "distinct_count",
    )


@query(
    "lineage_impact",
    """SELECT n_name AS node, 1 AS distance FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'
       UNION ALL SELECT c_name, 2 FROM customer JOIN nation ON c_nationkey = n_nationkey
                 JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'
       UNION ALL SELECT 'order ' || o_orderkey, 3 FROM orders JOIN customer ON o_custkey = c_custkey
                 JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""",
)
def lineage_impact(t):
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    edges = (
        nations.select(F.col("r_name").alias("source"), F.col("n_name").alias("target"))
        .union(customers.select("n_name", "c_name"))
        .union(orders.select("c_name", F.concat(F.lit("order "), "o_orderkey")))
    )
    return catalog.reachable(edges, ["ASIA"])


# Both dialects read this text.
STATEMENT = """CASE (conv_id + turn) % 9
    WHEN 0 THEN 'SELECT * FROM t WHERE note = ''' || replace(text, '''', ' ') || ''''
    WHEN 1 THEN '```sql' || chr(10) || 'SELECT turn FROM t;' || chr(10) || '```'
    WHEN 2 THEN 'WITH a AS (SELECT 1) SELECT * FROM a LIMIT ' || (turn * 60)
    WHEN 3 THEN 'drop TABLE t' || conv_id || ';'
    WHEN 4 THEN 'SELECT 1; DELETE FROM t WHERE id = ' || conv_id
    WHEN 5 THEN '  ;; '
    WHEN 6 THEN text
    WHEN 7 THEN 'SELECT replace(role, ''DROP'', '''') FROM t'
    ELSE '123 SELECT' END"""
AUDIT_SQL = f"""cleaned AS (SELECT conv_id, turn, kind, regexp_replace(CASE WHEN kind = 1 THEN 'SELECT turn FROM t'
        ELSE regexp_replace(regexp_replace(s, '^\\s+|\\s+$', '', 'g'), ';+$', '') END, '^\\s+|\\s+$', '', 'g') AS statement
    FROM (SELECT conv_id, turn, (conv_id + turn) % 9 AS kind, {STATEMENT} AS s FROM conversations)),
coded AS (SELECT *, regexp_replace(regexp_replace(statement, '''[^'']*''', '''''', 'g'), '"[^"]*"', '""', 'g') AS code FROM cleaned),
worded AS (SELECT *, upper(regexp_extract(code, '^\\s*([A-Za-z]+)', 1)) AS w,
    list_filter(['DROP', 'DELETE', 'UPDATE', 'INSERT', 'ALTER', 'TRUNCATE', 'CREATE', 'ATTACH', 'DETACH', 'COPY', 'INSTALL',
                 'LOAD', 'PRAGMA', 'EXEC', 'EXECUTE', 'REPLACE'], lambda k: regexp_matches(code, '(?i)\\b' || k || '\\b'))[1] AS k
    FROM coded),
audited AS (SELECT *, CASE WHEN statement = '' THEN 'empty' WHEN contains(code, ';') THEN 'several statements'
        WHEN w = '' THEN 'unknown statement' WHEN w NOT IN ('SELECT', 'WITH', 'DESCRIBE', 'EXPLAIN') THEN 'statement type'
        WHEN k IS NOT NULL THEN 'forbidden keyword' END AS reason FROM worded),
detailed AS (SELECT *, CASE reason WHEN 'statement type' THEN w WHEN 'forbidden keyword' THEN k END AS detail FROM audited)"""


def audited(t):
    statements = t.conversations.select("conv_id", "turn", F.expr(STATEMENT).alias("raw"))
    return audit.audit_statements(statements, "raw")


@query(
    "sql_audit",
    f"""WITH {AUDIT_SQL} SELECT conv_id, turn, statement, reason IS NULL AS is_safe, reason, detail,
            CASE WHEN reason IS NULL THEN least(coalesce(TRY_CAST(regexp_extract(statement, '(?i)\\bLIMIT\\s+(\\d+)\\s*$', 1) AS BIGINT), 50), 100) END AS row_limit
        FROM detailed""",
)
def sql_audit(t):
    return audited(t).drop("raw")


@query(
    "sql_audit_counts",
    f"WITH {AUDIT_SQL} SELECT reason IS NULL AS is_safe, reason, detail, count(*) AS statements FROM detailed GROUP BY ALL",
)
def sql_audit_counts(t):
    return audit.audit_counts(audited(t))

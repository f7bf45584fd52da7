"""Files: the given tables are written as raw files or published tables in the shared folder and
taken in again, so that readers, sinks, SQL names and publication are checked on real files."""

from pyspark.sql import functions as F

from tidemark.operators import contracts, scd, star
from tidemark.operators.mapping import look_up
from tidemark.operators.ordered import number_rows
from tidemark.plans import governance
from tidemark.session import durable, scratch_path
from tidemark.sources import readers, sinks
from tidemark.streaming import cdc_stream
from tidemark.workload.cdc import LATE_HOURS, SYNC_SQL
from tidemark.workload.governance import CONTRACT_SQL, RULES, contract_tables
from tidemark.workload.registry import query
from tidemark.workload.scd import SCD2_SQL, TIERS, scd2
from tidemark.workload.star import COMPANY_SQL, LATEST_SQL, ROLLUP_SQL, companies, company_keys, latest, observations, rollup, silver
from tidemark.workload.streams import FIELDS, LANDINGS, Feed, batches_sql

#: What text columns hold after a way through CSV, where an empty cell is no value.
PLAIN = "CASE WHEN {0} <> '' THEN {0} END"


@query(
    "raw_csv_folder",
    f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, {PLAIN.format("lang")} AS lang,
               CASE WHEN doc_id % 2 = 0 THEN {PLAIN.format("source")} END AS source, md5({PLAIN.format("text")}) AS text_md5,
               CASE WHEN doc_id % 2 = 1 THEN CAST(n_chars AS VARCHAR) END AS n_chars FROM documents""",
)
def raw_csv_folder(t):
    """Two tables of CSV files with different headers, united by name; outputs of earlier runs
    that lie between them are skipped."""
    folder = scratch_path(t.spark, "raw")
    even, odd = t.documents.filter("doc_id % 2 = 0"), t.documents.filter("doc_id % 2 = 1")
    sinks.write_table(even.select("doc_id", "text", "lang", "source"), f"{folder}/articles_a", "csv")
    sinks.write_table(odd.select("n_chars", "lang", "text", "doc_id"), f"{folder}/articles_b", "csv")
    for output in ("dim_article", "articles_clean.csv"):
        sinks.write_table(t.documents.select("doc_id"), f"{folder}/{output}", "csv")
    raw = readers.read_csv_folder(t.spark, f"{folder}/*")
    raw = readers.require_columns(raw, ["doc_id", "text", "lang"], "raw documents")
    return raw.select("doc_id", "lang", "source", F.md5("text").alias("text_md5"), "n_chars")


@query(
    "keyed_json",
    """SELECT 'file' AS form, n_name AS name, n_nationkey AS number, NULL AS segment FROM nation
       UNION ALL SELECT 'line', c_name, c_custkey, c_mktsegment FROM customer""",
)
def keyed_json(t):
    """Objects of objects: one file that is an object, and files of many objects, one a line."""
    folder, schema = scratch_path(t.spark, "keyed"), "number LONG, segment STRING"

    def objects(rows, name, value):
        return F.to_json(F.map_from_entries(rows(F.struct(F.col(name), value)))).alias("value")

    # the few nations fit one object; of customers each is an object of its own
    nation = objects(F.collect_list, "n_name", F.struct(F.col("n_nationkey").alias("number")))
    t.nation.agg(nation).write.text(f"{folder}/file")
    segment = F.struct(F.col("c_custkey").alias("number"), F.col("c_mktsegment").alias("segment"))
    t.customer.select(objects(F.array, "c_name", segment)).write.text(f"{folder}/line")
    parts = [
        readers.read_keyed_json(t.spark, f"{folder}/{form}", "name", schema, lines=form == "line")
        .select(F.lit(form).alias("form"), "name", "number", "segment")
        for form in ("file", "line")
    ]
    return parts[0].union(parts[1])


@query(
    "csv_na_token",
    """WITH raw AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'NULL' ELSE c_mktsegment END AS segment,
                           CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS balance FROM customer)
       SELECT 'token' AS reader, c_custkey, nullif(segment, 'NULL') AS segment, balance FROM raw
       UNION ALL SELECT 'typed', c_custkey, segment, balance FROM raw""",
)
def csv_na_token(t):
    """The text NULL is no value to the one reader and text to the other; a number that does not
    parse is null to both."""
    folder = scratch_path(t.spark, "customers")
    raw = t.customer.select(
        "c_custkey",
        F.expr("CASE WHEN c_custkey % 4 = 0 THEN 'NULL' ELSE c_mktsegment END").alias("segment"),
        F.expr("CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_acctbal AS STRING) ELSE 'none' END").alias("balance"),
    )
    sinks.write_table(raw, folder, "csv")
    text = readers.read_csv(t.spark, folder, raw.columns, null_value="NULL").select(
        F.lit("token").alias("reader"), F.col("c_custkey").cast("long"), "segment", F.expr("try_cast(balance AS DOUBLE)").alias("balance")
    )
    typed = readers.read_typed_csv(t.spark, folder, "c_custkey LONG, segment STRING, balance DOUBLE")
    return text.union(typed.select(F.lit("typed"), *raw.columns))


@query(
    "missing_sources",
    """SELECT c_custkey AS customer_id, 'Bronze' AS loyalty_tier, 5000 AS credit_limit_usd, '1996-01-01' AS last_updated_at,
              0 AS batches, 0 AS dead_letters FROM customer""",
)
def missing_sources(t):
    """Without order files every customer has the lowest tier; a stream that has not run has
    empty counters and no dead letters."""
    gone = scratch_path(t.spark, "absent")
    spend = readers.read_or_empty(t.spark, f"{gone}/spend", "o_custkey LONG, lifetime_spend DOUBLE")
    customers = t.customer.select(F.col("c_custkey").alias("customer_id"))
    wide = look_up(customers, spend, "customer_id", ["lifetime_spend"], "o_custkey")
    tiers = scd.tier_columns(F.col("lifetime_spend"), TIERS, ("loyalty_tier", "credit_limit_usd", "last_updated_at"))
    batches, letters = (read(t.spark, gone).count() for read in (cdc_stream.metrics, cdc_stream.dead_letters))
    return wide.withColumns(tiers).drop("lifetime_spend").withColumns(
        {"batches": F.lit(batches), "dead_letters": F.lit(letters)}
    )


BUNDLE_SQL = {
    "dim_company": f"WITH {COMPANY_SQL} SELECT company_id AS k, company_name AS v FROM company",
    "fct_article": f"""WITH {COMPANY_SQL} SELECT 'ART' || printf('%04d', o_orderkey), company_id
                       FROM orders LEFT JOIN company ON o_custkey = c_custkey""",
    "fct_observation": f"WITH {LATEST_SQL} SELECT 'ARR' || printf('%04d', seq), company_id || ' ' || m FROM obs",
    "agg_quarter": f"""WITH {ROLLUP_SQL} SELECT company_id || ' ' || observation_year || ' ' || observation_quarter,
                       observations_count || ' ' || "latest_arr_usd_M" FROM rollup_q""",
    "view_latest": f"WITH {LATEST_SQL} SELECT company_id, latest_article_id FROM latest",
}


@query(
    "warehouse_bundle",
    " UNION ALL ".join(f"SELECT '{name}' AS table_name, * FROM ({sql}) x(k, v)" for name, sql in BUNDLE_SQL.items()),
)
def warehouse_bundle(t):
    """Five tables written together over those of an earlier run, known to SQL by their names, and
    read by statements."""
    out = scratch_path(t.spark, "warehouse")
    tables = {
        "dim_company": companies(t).drop("c_custkey"),
        "fct_article": star.build_fact(silver(t), company_keys(t), "company_name", "company_id", ["article_id", "company_id"]),
        "fct_observation": observations(t),
        "agg_quarter": rollup(t),
        "view_latest": latest(t),
    }
    sinks.write_bundle({name: t.region for name in tables}, out)
    paths = sinks.write_bundle(tables, out)
    readers.register({name: t.spark.read.parquet(path) for name, path in paths.items()})
    t.spark.sql("CREATE OR REPLACE TEMP VIEW quarters AS SELECT 1 AS k")
    t.spark.sql(
        """CREATE OR REPLACE TEMP VIEW quarters AS
           SELECT concat_ws(' ', company_id, observation_year, observation_quarter) AS k,
                  concat_ws(' ', observations_count, CAST(latest_arr_usd_M AS LONG)) AS v FROM agg_quarter"""
    )
    return t.spark.sql(
        """SELECT 'dim_company' AS table_name, company_id AS k, company_name AS v FROM dim_company
           UNION ALL SELECT 'fct_article', article_id, company_id FROM fct_article
           UNION ALL SELECT 'fct_observation', observation_id, concat(company_id, ' ', CAST(arr_usd_M AS LONG)) FROM fct_observation
           UNION ALL SELECT 'agg_quarter', k, v FROM quarters
           UNION ALL SELECT 'view_latest', company_id, latest_article_id FROM view_latest"""
    )


@query("report_read_back", f"WITH {CONTRACT_SQL} SELECT * FROM results")
def report_read_back(t):
    """The report on contracts, from its JSON file."""
    results, path = contracts.evaluate(contract_tables(t), RULES), scratch_path(t.spark, "report")
    sinks.write_report(results, path)
    return t.spark.read.schema(results.schema).json(path)


@query(
    "vectors_read_back",
    """SELECT vec_id, label, len(embedding) AS dims, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total,
              round(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x, i: x * i)), 6) AS placed FROM embeddings""",
)
def vectors_read_back(t):
    """Vectors of doubles stored as single floats; the weighted sum notices an order that changed."""
    path = scratch_path(t.spark, "vectors")
    sinks.write_vectors(t.embeddings.withColumn("embedding", F.col("embedding").cast("array<double>")), path)
    stored = t.spark.read.schema("vec_id LONG, label INT, embedding ARRAY<FLOAT>").parquet(path)
    double = F.col("embedding").cast("array<double>")
    add = lambda values: F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 6)
    return stored.select(
        "vec_id", "label", F.size("embedding").alias("dims"), add(double).alias("total"),
        add(F.transform(double, lambda x, i: x * (i + 1))).alias("placed"),
    )


@query(
    "snapshot_on_change",
    """SELECT * FROM (VALUES (0, true), (1, false), (2, true), (3, true), (4, false)) v(tick, changed),
           LATERAL (SELECT count(*) AS rows FROM orders WHERE tick < 3 OR o_orderstatus <> 'F') c""",
)
def snapshot_on_change(t):
    """A snapshot is written at first, when a value changes and when rows go, and left alone when
    the same rows come in another order."""
    path = scratch_path(t.spark, "snapshot")
    raised = t.orders.withColumn("o_totalprice", F.expr("CASE WHEN o_orderkey = 0 THEN o_totalprice + 1 ELSE o_totalprice END"))
    fewer = raised.filter("o_orderstatus <> 'F'")
    rounds = (t.orders, t.orders.repartition("o_orderstatus"), raised, fewer, fewer.orderBy(F.desc("o_orderdate")))
    ticks = [(number, *sinks.write_if_changed(rows, path)) for number, rows in enumerate(rounds)]
    return t.spark.createDataFrame(ticks, "tick INT, changed BOOLEAN, rows LONG")


@query(
    "version_order",
    f"""WITH {SCD2_SQL} SELECT row_number() OVER (ORDER BY customer_id, s) - 1 AS place, customer_id,
            loyalty_tier, strftime(s, '%Y-%m-%d') AS effective_start_date FROM scd2""",
)
def version_order(t):
    """The place of each version in the published files."""
    path = scratch_path(t.spark, "versions")
    sinks.write_table(scd.version_order(scd2(t), ["customer_id"]), path, "csv")
    stored = readers.read_csv(t.spark, path, scd2(t).columns, ordered=True)
    placed = number_rows(stored, readers.ORDER, "place", 0)[0]
    return placed.select("place", F.col("customer_id").cast("long"), "loyalty_tier", "effective_start_date")


@query("stream_poll", f"WITH {batches_sql()} {SYNC_SQL.format(events='good')}")
def stream_poll(t):
    """One stream that polls the folder while files land in it."""
    feed = Feed(t, "json")
    feed.land(0)
    source = cdc_stream.event_stream(t.spark, f"{feed.landing}/*", "json", FIELDS)
    running = cdc_stream.start(
        source, feed.root, cdc_stream.event_time(LATE_HOURS), {"processingTime": "1 second"}, feed.state.after_batch, FIELDS
    )
    try:
        running.processAllAvailable()
        for number in range(1, LANDINGS):
            feed.land(number)
            running.processAllAvailable()
    finally:
        running.stop()
    return feed.state.table("live")


SHOP_RULES = (
    contracts.unique("orders", "o_orderkey"),
    contracts.not_null("orders", "o_custkey"),
    contracts.in_range("orders", "o_totalprice", low=0.0, allow_null=False),
    contracts.references("orders", "o_custkey", "customer", "c_custkey"),
)
#: How the given tables come from each other, stage by stage.
SHOP_FLOWS = (
    {"domain": "shop", "stages": [["region"], ["nation"], ["customer", "supplier"], ["orders"], ["lineitem"]]},
    {"domain": "text", "stages": [["documents"], ["labels"]]},
)
SHOP_KEYS = (
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("labels", "doc_id", "documents", "doc_id"),
)
SHOP_TABLES = {
    "region": "Regions of the world.",
    "nation": "Nations and their region.",
    "customer": "One row per customer.",
    "supplier": "One row per supplier.",
    "orders": "One row per order.",
    "lineitem": "One row per position of an order.",
    "documents": "One row per text.",
    "labels": "Marks of texts.",
}


@query(
    "circuit_breaker",
    """SELECT 'broken' AS run, false AS published, 3 AS failed, NULL AS o_orderpriority, 0 AS orders
       UNION ALL SELECT 'mended', true, 0, CASE WHEN o_orderkey % 250 <> 3 THEN o_orderpriority END AS p, count(*) FROM orders
           WHERE o_orderkey % 50 <> 0 AND o_orderkey % 300 <> 7 AND o_custkey % 10 <> 9 GROUP BY p""",
)
def circuit_breaker(t):
    """Tables that break a rule are not published: nothing lies in the folder but the report. The
    same tables without the broken rows are."""
    broken = contract_tables(t)
    orders = broken["orders"].filter("o_custkey IS NOT NULL AND o_totalprice >= 0")
    mended = orders.join(broken["customer"].select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi")
    parts = []
    for run, rows in (("broken", broken["orders"]), ("mended", mended.select(*broken["orders"].columns))):
        out, tables = scratch_path(t.spark, run), {"orders": durable(rows, "orders"), "customer": broken["customer"]}
        try:
            governance.publish(t.spark, tables, out, rules=SHOP_RULES, flows=SHOP_FLOWS)
            published = True
        except contracts.ContractViolation:
            published = False
        report = t.spark.read.schema("status STRING").json(f"{out}/data_quality_report")
        failed = report.filter("status = 'FAIL'").count()
        stored = readers.read_or_empty(t.spark, f"{out}/orders", rows.schema)
        counted = stored.groupBy("o_orderpriority").agg(F.count("*").alias("orders"))
        if not published:
            counted = stored.agg(F.lit(None).cast("string").alias("o_orderpriority"), F.count("*").alias("orders"))
        parts.append(counted.select(F.lit(run).alias("run"), F.lit(published).alias("published"), F.lit(failed).alias("failed"), "*"))
    return parts[0].union(parts[1])


def _edges_sql():
    edges = [
        (flow["domain"], left, right)
        for flow in SHOP_FLOWS
        for a, b in zip(flow["stages"], flow["stages"][1:], strict=False)
        for left in a
        for right in b
    ]
    return " UNION ALL ".join(
        f"""SELECT '{d}' AS domain, '{a}' AS source, '{b}' AS target, (SELECT count(*) FROM {a}) AS source_rows,
            (SELECT count(*) FROM {b}) AS target_rows""" for d, a, b in edges
    )


def _sizes(t):
    """The rows of each described table."""
    counts = [getattr(t, n).agg(F.lit(n).alias("name"), F.count("*").alias("rows")) for n in SHOP_TABLES]
    out = counts[0]
    for count in counts[1:]:
        out = out.union(count)
    return durable(out, "sizes")


@query("lineage_graph", _edges_sql())
def lineage_graph(t):
    """The declared flow as edges, with the rows at both ends."""
    sizes = _sizes(t)
    edges = governance.lineage(t.spark, SHOP_FLOWS)
    for end in ("source", "target"):
        edges = edges.join(sizes.select(F.col("name").alias(end), F.col("rows").alias(f"{end}_rows")), end)
    return edges.select("domain", "source", "target", "source_rows", "target_rows")


@query(
    "table_metadata",
    " UNION ALL ".join(
        [
            f"""SELECT '{t}' AS table_name, '{SHOP_TABLES[t]}' AS description, '{c} -> {p}.{q}' AS foreign_key,
                (SELECT count(*) FROM {t}) AS rows, (SELECT count(*) FROM {t} WHERE {c} IS NULL OR {c} NOT IN (SELECT {q} FROM {p})) AS orphans"""
            for t, c, p, q in SHOP_KEYS
        ]
        + [
            f"SELECT '{t}', '{text}', NULL, (SELECT count(*) FROM {t}), NULL"
            for t, text in SHOP_TABLES.items()
            if t not in {k[0] for k in SHOP_KEYS}
        ]
    ),
)
def table_metadata(t):
    """Descriptions and foreign keys of the tables, with their rows and with the rows that a key
    does not resolve for."""
    described = governance.table_metadata(t.spark, SHOP_TABLES, SHOP_KEYS)
    tables = {n: getattr(t, n) for n in SHOP_TABLES}
    rules = [contracts.references(*key) for key in SHOP_KEYS]
    broken = contracts.evaluate(tables, rules).select("table_name", F.col("target").alias("foreign_key"), F.col("violations").alias("orphans"))
    sized = described.join(_sizes(t).withColumnRenamed("name", "table_name"), "table_name")
    return sized.join(broken, ["table_name", "foreign_key"], "left").select(
        "table_name", "description", "foreign_key", "rows", "orphans"
    )

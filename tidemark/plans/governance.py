"""Contracts, catalog and lineage of the two domains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import catalog, contracts
from tidemark.operators.contracts import Rule, in_range, not_null, one_of, references, unique
from tidemark.plans import fixed_values as fixed
from tidemark.session import inline_table
from tidemark.sources import sinks

# The rules, in the order of the report.
RULES = (
    unique("dim_company", "company_id"),
    not_null("dim_company", "company_name"),
    not_null("fct_article", "article_id"),
    not_null("fct_article", "published_date_clean"),
    one_of("fct_article", "category_clean", fixed.ALLOWED_CATEGORIES, allow_null=False),
    references("fct_arr_observation", "company_id", "dim_company", "company_id"),
    in_range("fct_arr_observation", "arr_usd_M", 0.0, allow_null=False, target="arr_usd_M > 0"),
    in_range("fct_arr_observation", "observation_year", 2000, 2030, allow_null=False,
             target="observation_year BETWEEN 2000 AND 2030"),
    unique("dim_customer_scd1", "customer_id"),
    not_null("dim_customer_scd1", "loyalty_tier"),
    not_null("dim_customer_scd1", "last_updated_at"),
    unique("dim_customer_scd2", "customer_sk"),
    not_null("dim_customer_scd2", "effective_start_date"),
    not_null("dim_customer_scd2", "effective_end_date"),
    not_null("dim_customer_scd2", "is_current_flag"),
    one_of("dim_customer_scd2", "loyalty_tier", fixed.ALLOWED_TIERS,
           target="loyalty_tier IN (Bronze, Silver, Gold, Platinum)"),
    unique("dim_customer_scd3", "customer_id"),
    not_null("dim_customer_scd3", "current_loyalty_tier"),
    in_range("dim_customer_scd3", "current_credit_limit_usd", 0.0, target="current_credit_limit_usd >= 0"),
    unique("dim_product", "product_sk"),
    in_range("dim_product", "unit_price", 0.0, target="unit_price >= 0"),
    one_of("dim_product", "stock_status", fixed.ALLOWED_STOCK),
    references("fct_orders", "customer_sk", "dim_customer_scd2", "customer_sk"),
    in_range("fct_orders", "total_net_amount", 0.0, target="total_net_amount >= 0"),
    references("fct_order_items", "order_id", "fct_orders", "order_id"),
    references("fct_order_items", "product_sk", "dim_product", "product_sk"),
    in_range("fct_order_items", "discount_rate", 0.0, 1.0, target="discount_rate BETWEEN 0.0 AND 1.0"),
    in_range("fct_order_items", "line_net_amount", 0.0, target="line_net_amount >= 0"),
    in_range("agg_customer_rfm", "r_score", 1, 4, target="r_score BETWEEN 1 AND 4"),
    in_range("agg_customer_rfm", "f_score", 1, 4, target="f_score BETWEEN 1 AND 4"),
    in_range("agg_customer_rfm", "m_score", 1, 4, target="m_score BETWEEN 1 AND 4"),
)

# The declared flows, stage by stage.
FLOWS = (
    {
        "domain": "news",
        "stages": [
            ["raw/articles.csv", "raw/company_metadata.json"],
            ["news.read_raw"],
            ["articles_clean"],
            ["dim_company", "fct_article", "fct_arr_observation", "agg_company_quarterly_arr",
             "view_company_latest_arr", "ai_articles_enriched"],
            ["SQL exploration", "vector search"],
        ],
    },
    {
        "domain": "retail",
        "stages": [
            ["raw/ecommerce/customers.csv", "raw/ecommerce/orders.csv", "raw/ecommerce/order_details.csv"],
            ["retail.read_customers"],
            ["silver_customers"],
            ["dim_customer_scd1", "dim_customer_scd2", "dim_customer_scd3"],
            ["point-in-time audits", "as-of reporting", "previous state cohorts"],
        ],
    },
    {
        "domain": "streaming",
        "stages": [
            ["stream_landing"],
            ["cdc_stream.start"],
            ["late filter and dead letters"],
            ["cdc_stream.snapshot"],
            ["operational dashboards"],
        ],
    },
)

# How the derived columns come about.
COLUMN_RULES = (
    ("fct_arr_observation.arr_usd_M", "articles.csv.revenue", "currency, rate to USD, range midpoint, millions"),
    ("dim_company.company_name", "articles.csv.company_name", "company aliases"),
    ("fct_article.category_clean", "articles.csv.category", "category codes"),
    ("dim_customer_scd1.loyalty_tier", "customers.csv and spend", "type 1: current tier, overwritten"),
    ("dim_customer_scd2.is_current_flag", "customers.csv and orders.csv", "type 2: open end date"),
    ("dim_customer_scd3.previous_loyalty_tier", "customers.csv and spend", "type 3: tier before the change"),
)


def validate(tables: Mapping[str, DataFrame], rules: Sequence[Rule] = RULES) -> tuple[DataFrame, DataFrame]:
    """Rule results and scorecard."""
    results = contracts.evaluate(tables, rules)
    return results, contracts.scorecard(results)


def lineage(spark: SparkSession, flows: Sequence[Mapping] = FLOWS) -> DataFrame:
    return catalog.lineage_edges(spark, flows)


def column_rules(spark: SparkSession) -> DataFrame:
    names = ("output_column", "source_column", "transformation")
    return inline_table(spark, {n: [r[i] for r in COLUMN_RULES] for i, n in enumerate(names)})


def table_metadata(
    spark: SparkSession,
    descriptions: Mapping[str, str] = fixed.TABLE_DESCRIPTIONS,
    foreign_keys: Sequence[tuple[str, str, str, str]] = fixed.FOREIGN_KEYS,
) -> DataFrame:
    """One row per described table and foreign key."""
    rows = []
    for table, description in descriptions.items():
        keys = [f"{c} -> {parent}.{p}" for t, c, parent, p in foreign_keys if t == table]
        rows += [(table, description, k) for k in keys or [None]]
    names = ("table_name", "description", "foreign_key")
    return inline_table(spark, {n: [r[i] for r in rows] for i, n in enumerate(names)})


def build_catalog(
    spark: SparkSession, tables: Mapping[str, DataFrame], flows: Sequence[Mapping] = FLOWS
) -> dict[str, DataFrame]:
    return {
        "column_profiles": catalog.profile_tables(tables),
        "lineage_edges": lineage(spark, flows),
        "column_rules": column_rules(spark),
        "table_metadata": table_metadata(spark),
    }


def publish(
    spark: SparkSession, tables: Mapping[str, DataFrame], out: str, fmt: str = "parquet",
    rules: Sequence[Rule] = RULES, flows: Sequence[Mapping] = FLOWS,
) -> DataFrame:
    """Write the report, then the tables and the catalog, unless a rule failed."""
    results, _ = validate(tables, rules)
    sinks.write_report(results, f"{out}/data_quality_report")
    report = spark.read.schema(results.schema).json(f"{out}/data_quality_report")
    contracts.enforce(report)
    sinks.write_bundle(tables, out, fmt)
    for name, df in build_catalog(spark, tables, flows).items():
        sinks.write_report(df, f"{out}/catalog/{name}")
    return contracts.scorecard(report)

"""News lakehouse: raw articles and company metadata to a star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, money, numbers, text
from tidemark.operators import filters, mapping, ordered, star
from tidemark.operators.rows import first_per_key
from tidemark.plans import fixed_values as fixed
from tidemark.session import durable
from tidemark.sources import readers, sinks

COMPANY_SCHEMA = (
    "founded_year STRING, headquarters STRING, employee_count STRING, industry STRING, "
    "is_public STRING, stock_ticker STRING"
)
COMPANY_ATTRIBUTES = ["industry", "headquarters", "founded_year", "employee_count", "is_public", "stock_ticker"]
ARTICLE_COLUMNS = [
    "article_id", "original_index", "company_name_clean", "has_company_metadata", "title", "category",
    "category_clean", "author", "published_date_clean", "published_year", "published_quarter",
    "published_month", "published_year_month", "word_count", "revenue_usd_M", "summary", "url",
]


def read_raw(spark: SparkSession, folder: str, metadata: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Articles (first row per id, with their row number) and companies."""
    articles = readers.read_csv_folder(spark, folder, ordered=True)
    readers.require_columns(articles, fixed.ARTICLE_REQUIRED, "raw articles")
    first = first_per_key(articles, ["article_id"], readers.ORDER)
    numbered = ordered.dense_sequence(first, readers.ORDER, "original_index", start=0).drop(*readers.ORDER)
    path = metadata or f"{folder.rstrip('/')}/company_metadata.json"
    companies = readers.read_keyed_json(spark, path, "company_name", COMPANY_SCHEMA)
    return numbered, readers.require_columns(companies, fixed.COMPANY_REQUIRED, "company metadata")


def clean(articles: DataFrame, companies: DataFrame) -> DataFrame:
    """Silver: 25 columns, and ``published_on`` as a real date."""
    for optional in ("author", "revenue", "word_count"):
        if optional not in articles.columns:
            articles = articles.withColumn(optional, F.lit(None).cast("string"))
    named = mapping.map_values(articles, "company_name", fixed.COMPANY_ALIASES, "company_name_clean")
    companies = companies.withColumns(
        {
            "founded_year": numbers.to_long(F.col("founded_year").cast("string")),
            "employee_count": numbers.to_long(F.col("employee_count").cast("string")),
            "is_public": numbers.to_bool(F.col("is_public")),
        }
    )
    tidy = text.clean_text_columns(named, ["article_id", "title", "category", "summary", "url", "author"])
    revenue = F.col("revenue")
    parsed = tidy.withColumns(
        {
            "published_on": dates.expand_two_digit_year(dates.parse_date(F.col("published_date")), 68),
            "_currency": money.currency_of(revenue),
            "_amount": money.amount_of(revenue),
        }
    )
    usd = money.convert(F.col("_amount"), F.col("_currency"), fixed.RATES_TO_USD)
    shaped = mapping.map_values(parsed, "category", fixed.CATEGORY_CODES, "category_clean").withColumns(
        {
            **dates.date_parts(F.col("published_on"), "published", "published_date_clean"),
            "revenue_usd_M": numbers.to_millions(usd),
            "author": F.coalesce("author", F.lit("Unknown")),
            "word_count": numbers.to_long(F.col("word_count").cast("string")),
        }
    )
    # one look-up gives the attributes and the membership flag
    known = companies.withColumn("_known", F.lit(True))
    joined = mapping.look_up(
        shaped, known, "company_name_clean", [*COMPANY_ATTRIBUTES, "_known"], "company_name"
    )
    return joined.withColumns(
        {
            "has_company_metadata": F.col("_known").isNotNull(),
            "company_age": (F.col("published_year") - F.col("founded_year")).cast("long"),
            "company_size_category": numbers.size_bucket(F.col("employee_count")),
        }
    ).select(*ARTICLE_COLUMNS, *COMPANY_ATTRIBUTES, "company_age", "company_size_category", "published_on")


def silver_order(date_order: str = "text") -> list[Column]:
    """Order of the silver rows, nulls last. ``text`` sorts the day text dd-mm-yyyy, as
    the published figures do; ``date`` sorts by time."""
    day = {"text": "published_date_clean", "date": "published_on"}[date_order]
    return [
        F.struct(F.col(c).isNull(), F.col(c))
        for c in ("company_name_clean", "category_clean", "author", day, "original_index")
    ]


def enriched_cohort(silver: DataFrame) -> DataFrame:
    """AI articles of 2022 to 2024 with a revenue above 50 million."""
    kept = filters.cohort(
        silver,
        any_of=[("category_clean", "AI_ML"), ("industry", "AI/ML")],
        between=("published_year", 2022, 2024),
        above=("revenue_usd_M", 50),
    )
    return kept.select(
        "article_id", "title",
        F.col("company_name_clean").alias("company_name"),
        F.col("published_date_clean").alias("published_date"),
        F.col("category_clean").alias("category"),
        numbers.from_millions(F.col("revenue_usd_M")).alias("arr_usd"),
        "summary", "url", "industry", "founded_year", "headquarters", "employee_count", "is_public",
        "stock_ticker", "company_age", "company_size_category",
        F.lit("[]").alias("embedding"),
    )


def build_warehouse(silver: DataFrame, date_order: str = "text") -> dict[str, DataFrame]:
    """The gold tables. The silver table is written down once: six tables read it."""
    silver = durable(silver, "silver")
    order = silver_order(date_order)
    name, key = "company_name_clean", "company_id"
    keys = star.surrogate_keys(silver, name, key)
    attributes = [
        "industry", "headquarters", "founded_year", "employee_count", "company_size_category",
        "is_public", "stock_ticker", "has_company_metadata",
    ]
    dim = star.build_dimension(silver, keys, name, key, attributes, order, "company_name")
    articles = star.build_fact(
        silver, keys, name, key,
        ["article_id", "original_index", key, "title", "category", "category_clean", "author",
         "published_date_clean", "published_year", "published_quarter", "published_month",
         "published_year_month", "word_count", "summary", "url"],
    )
    numbered = star.build_observations(
        silver.withColumnRenamed("revenue_usd_M", "arr_usd_M"), keys, name, key, "arr_usd_M", order,
        {
            "article_id": "article_id",
            "published_date_clean": "observation_date",
            "published_year": "observation_year",
            "published_quarter": "observation_quarter",
            "published_year_month": "observation_year_month",
        },
    )
    columns = [
        "observation_id", "article_id", key, "observation_date", "observation_year",
        "observation_quarter", "observation_year_month", "arr_usd_M", "arr_usd",
    ]
    rollup = star.quarterly_rollup(numbered, dim, key, "arr_usd_M", ["_seq"])
    latest = star.latest_view(
        numbered, dim, key, ["observation_year", "observation_quarter", "_seq"],
        {
            "observation_id": "latest_observation_id",
            "article_id": "latest_article_id",
            "observation_date": "latest_observation_date",
            "arr_usd_M": "latest_arr_usd_M",
        },
        ["company_name", "industry", "company_size_category", "is_public"],
    )
    return {
        "articles_clean": silver,
        "dim_company": dim,
        "fct_article": articles,
        "fct_arr_observation": numbered.select(*columns),
        "agg_company_quarterly_arr": rollup,
        "view_company_latest_arr": latest,
        "ai_articles_enriched": enriched_cohort(silver),
    }


def run(
    spark: SparkSession, raw: str, out: str | None = None, date_order: str = "text", fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Raw files to gold tables, written under ``out`` when it is given."""
    tables = build_warehouse(clean(*read_raw(spark, raw)), date_order)
    if out:
        sinks.write_bundle(tables, out, fmt)
    return tables
